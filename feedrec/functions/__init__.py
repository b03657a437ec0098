from .columns import (THEME_DEFAULTS, TAG_SEPARATOR, TAG_STOP_PATTERN, act_weight, age_days,
                      java_split, nonempty, r6, r9, split_limit, time_decay, tokenize_tags)
from .ranking import normalize, top_n

__all__ = ["THEME_DEFAULTS", "TAG_SEPARATOR", "TAG_STOP_PATTERN", "act_weight", "age_days",
           "java_split", "nonempty", "r6", "r9", "split_limit", "time_decay", "tokenize_tags",
           "normalize", "top_n"]
