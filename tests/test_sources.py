"""Scans: partition pruning on pt, and the tokeniser against a plain model of
the JVM split / full-match rules on random strings."""

import os
import random
import re
import tempfile

from pyspark.sql import functions as F

from feedrec.functions.columns import TAG_STOP_PATTERN, tokenize_tags
from feedrec.params import DEFAULT
from feedrec.sources import fixtures as FX
from feedrec.sources.readers import behavior_window


def test_window_prunes_pt_partitions(spark, sf):
    path = os.path.join(tempfile.mkdtemp(prefix="feedrec-beh-"), "behavior")
    FX.behavior(spark, sf).write.partitionBy("pt").parquet(path)
    since = DEFAULT.day_before(DEFAULT.days_cf)
    w = behavior_window(spark.read.parquet(path), since)
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pt" in plan and since in plan
    assert w.count() == behavior_window(FX.behavior(spark, sf), since).count()


def model_tokens(s):
    """JVM String.split(",|，") then drop whole-token stop matches."""
    if s == "":
        parts = [""]
    else:
        parts = re.split("[,，]", s)
        while parts and parts[-1] == "":
            parts.pop()
    stop = re.compile(TAG_STOP_PATTERN.replace("\\x0B", "\x0b"))
    return [t for t in parts if not stop.fullmatch(t)]


def test_tokenizer_matches_model(spark):
    rnd = random.Random(7)
    alphabet = ["a", "b", ",", "，", " ", "\t", "其", "他", "其他", ".", "。", "|", "\\", "\n"]
    strings = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(400)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", tokenize_tags(F.col("s")).alias("t")).collect()}
    for i, s in enumerate(strings):
        assert got[i] == model_tokens(s), repr(s)
