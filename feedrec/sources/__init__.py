from .fixtures import behavior, catalog, catalog_lines, events_behavior, table
from .readers import (CATALOG_FIELDS, LIST_SEP, behavior_window, download_window,
                      parse_catalog_lines, read_catalog, read_profile_list, read_sim_list)

__all__ = ["behavior", "catalog", "catalog_lines", "events_behavior", "table", "CATALOG_FIELDS",
           "LIST_SEP", "behavior_window", "download_window", "parse_catalog_lines",
           "read_catalog", "read_profile_list", "read_sim_list"]
