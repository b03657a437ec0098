"""Every tunable of the four batch jobs in one frozen dataclass.

Names follow the settings keys the jobs were configured with; the values are our
own fixture choices (the original settings file is not public).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class Params:
    # job date; every window and every decay is measured from it
    as_of: str = "2001-08-01"

    # windows, in days
    days_cf: int = 730            # behaviour used for user-user CF (strict >)
    days_profile: int = 730       # behaviour used for the tag profile (strict >)
    days_history: int = 1095      # download history update (>=)
    days_hot: int = 365           # hot list (>=)
    days_als: int = 730           # implicit ratings (strict >)

    # action weights
    scan_factor: float = 1.0
    download_factor: float = 5.0
    als_scan: float = 1.0
    als_download: float = 7.0

    # user CF
    theme_max_user: int | None = None  # opt-in sample of heavy (theme, act) groups; None: all users
    cap_sample: int = 6           # sample size of the capped_users report (O14)
    pair_block: int = 1024        # users of a (theme, act) group paired in one join key
    head_share: float = 0.25      # share of all pairs formed before pruning starts,
    head_per_result: int = 4      # or so many pairs a result row, whichever is more
    n_sim_users: int = 10
    max_theme_from_sim: int = 30  # early stop of the neighbour walk
    list_size_sim: int = 20
    n_hot: int = 100
    drop_zero: bool = False       # prune 'other' actions before the pair join
    dedupe_backfill: bool = False

    # tag profile
    time_decay: float = 0.1
    contingency: float = 0.5
    max_profile_tag: int = 4
    max_similar_tag: int = 5
    max_theme_per_tag: int = 30
    min_recall: int = 200
    min_profile_weight: float = 0.2
    n_theme_per_user: int = 20

    # implicit ALS
    als_implicit: bool = True     # False: explicit feedback
    als_rank: int = 10
    als_iters: int = 10
    als_lambda: float = 0.01
    als_alpha: float = 1.0
    als_blocks: int = -1          # -1: Spark's default block count
    als_decay: float = 0.1
    als_fallback_days: int = 180

    # sorted key export: region start keys (first is the empty key) and
    # files per region, clamped to 1..32; the jobs take both from the data
    split_keys: tuple = ("", "3", "6")
    files_per_region: int = 4
    rows_per_file: int = 5_000_000

    seed: int = 42
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    def with_text(self, settings: list[str]) -> "Params":
        """``name=value`` settings, read by the field's type."""
        kw = {}
        for line in settings:
            name, _, text = line.partition("=")
            name, text = name.strip(), text.strip()
            kind = {f.name: f.type for f in fields(self)}[name]
            if kind == "tuple":
                kw[name] = ("", *filter(None, text.split(",")))
            elif kind == "bool":
                kw[name] = {"true": True, "false": False}[text.lower()]
            elif kind.startswith("int"):
                kw[name] = None if text.lower() == "none" else int(text)
            else:
                kw[name] = float(text) if kind == "float" else text
        return replace(self, **kw)

    # ---- derived day strings (driver-side constants, so the comparison on
    # the raw partition column stays prunable) ----
    def _minus(self, days: int) -> _dt.date:
        return _dt.date.fromisoformat(self.as_of) - _dt.timedelta(days=days)

    def day_before(self, days: int) -> str:
        return self._minus(days).isoformat()

    def datetime_before(self, days: int) -> str:
        return self._minus(days).isoformat() + " 00:00:00"

    @property
    def as_of_ts(self) -> str:
        return self.as_of + " 00:00:00"


DEFAULT = Params()

EXPORT_ROWS = 400  # rows of one file of the sorted_export query
