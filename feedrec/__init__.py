"""feedrec: a Spark-native batch engine for recommendation feeds."""

from .params import DEFAULT, Params

__all__ = ["DEFAULT", "Params"]
