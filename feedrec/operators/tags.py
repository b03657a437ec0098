"""Theme tags: features (O22), tag similarity (O27), recall list (O28), index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import r6, r9, tokenize_tags
from ..functions.ranking import normalize, top_n
from ..params import Params
from .usercf import mirror

REQUIRED = ["id", "uid", "grade", "quality", "ctime", "tags"]


def complete_rows(catalog: DataFrame) -> DataFrame:
    """Catalogue rows that have every field the tag jobs read (a short line
    would fail the original job; here it is left out)."""
    cond = None
    for c in REQUIRED:
        e = F.col(c).isNotNull()
        cond = e if cond is None else cond & e
    return catalog.where(cond)


def theme_tokens(catalog: DataFrame, reused: bool = False) -> DataFrame:
    """O21 applied to the catalogue: (theme_id, author, grade, quality,
    ctime, tokens array)."""
    # Tokenised once per row (a one-row generator keeps later filters on
    # ``tokens`` from re-inlining the tokeniser). ``reused``: hash-partition by
    # theme, so that several branches start from this one exchange instead of
    # each re-reading and re-tokenising the catalogue.
    rows = complete_rows(catalog).select(
        F.col("id").alias("theme_id"), F.col("uid").alias("author"), "grade", "quality", "ctime",
        tokenize_tags(F.col("tags")).alias("tokens"))
    rows = rows.select(F.inline(F.array(F.struct("theme_id", "author", "grade", "quality", "ctime", "tokens"))))
    return rows.repartition("theme_id") if reused else rows


def tag_token_rows(catalog: DataFrame) -> DataFrame:
    """Flat tokens with their position: (theme_id, pos, tag)."""
    return theme_tokens(catalog).select(
        "theme_id", F.posexplode("tokens").alias("pos", "tag")
    ).withColumn("pos", F.col("pos").cast("long"))


def theme_tag_features(catalog: DataFrame) -> DataFrame:
    """Themes with more than one token; author productivity = distinct
    such themes per author, tag popularity = distinct such themes per tag.
    Output (theme_id, author, author_n, tag, tag_n), one row per distinct
    (theme, tag). Both counts are partial/final aggregates, and the joins
    back carry one row per author / tag, so a hot tag is split by AQE."""
    multi = theme_tokens(catalog, reused=True).where(F.size("tokens") > 1)
    pairs = multi.select("theme_id", "author", F.explode(F.array_distinct("tokens")).alias("tag"))
    author_n = (multi.select("author", "theme_id").distinct()
                .groupBy("author").agg(F.count(F.lit(1)).alias("author_n")))
    tag_n = (pairs.select("tag", "theme_id").distinct()
             .groupBy("tag").agg(F.count(F.lit(1)).alias("tag_n")))
    return (pairs.join(author_n, "author").join(tag_n, "tag")
            .select("theme_id", "author", "author_n", "tag", "tag_n"))


def similar_tags_raw(features: DataFrame) -> DataFrame:
    """O27 before ranking: each unordered tag pair of a theme (with more than
    one distinct tag) gives 1 / (1 + log10(author_n)) / sqrt(n1 * n2);
    summed per pair and mirrored. Output (tag, sim_tag, sim)."""
    a = features.select("theme_id", "author_n", F.col("tag").alias("t1"), F.col("tag_n").alias("n1"))
    b = features.select(F.col("theme_id").alias("tb"), F.col("tag").alias("t2"), F.col("tag_n").alias("n2"))
    j = a.join(b, (F.col("theme_id") == F.col("tb")) & (F.col("t1") < F.col("t2")))
    f = (F.lit(1.0) / (F.lit(1.0) + F.log10(F.col("author_n").cast("double")))
         / F.sqrt(F.col("n1").cast("double") * F.col("n2").cast("double")))
    sums = j.select("t1", "t2", f.alias("f")).groupBy("t1", "t2").agg(F.sum("f").alias("sim"))
    return mirror(sums, "t1", "t2", "tag", "sim_tag", "sim")


def similar_tags(features: DataFrame, p: Params) -> DataFrame:
    """Top ``max_similar_tag`` per tag, normalised.
    Output (tag, sim_tag, rank, raw, weight)."""
    raw = similar_tags_raw(features)
    top = top_n(raw, "tag", [r9("sim").desc(), F.col("sim_tag").asc()], p.max_similar_tag)
    norm = normalize(top, "tag", "sim_tag", "sim")
    return norm.select("tag", "sim_tag", "rank", r6("sim").alias("raw"), r6("weight").alias("weight"))


def tag_recall(catalog: DataFrame, k: int) -> DataFrame:
    """Per tag, themes by (grade, quality, ctime) descending as strings,
    first ``k``; single-tag themes count here. The per-tag top-k is limited
    map-side, so a tag carried by most themes ships k rows per task.
    Output (tag, rank, theme_id, grade, quality, ctime, tokens)."""
    t = theme_tokens(catalog)
    e = t.select(F.explode(F.array_distinct("tokens")).alias("tag"), "theme_id", "grade", "quality",
                 "ctime", "tokens")
    order = [F.col("grade").desc(), F.col("quality").desc(), F.col("ctime").desc(), F.col("theme_id").asc()]
    return top_n(e, "tag", order, k).select("tag", "rank", "theme_id", "grade", "quality", "ctime", "tokens")


def tag_index(simtags: DataFrame, recall: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep only tags that have both lists (inner join on tag). Returns
    (recall lists ``ls``, similar-tag lists ``tg``) as two long tables."""
    both = simtags.select("tag").distinct().join(recall.select("tag").distinct(), "tag")
    ls = recall.join(both, "tag", "left_semi")
    tg = simtags.join(both, "tag", "left_semi")
    return ls, tg


def tag_index_rows(ls: DataFrame, tg: DataFrame) -> DataFrame:
    """Flat view of the index: (tag, kind, rank, item, weight)."""
    a = ls.select("tag", F.lit("ls").alias("kind"), "rank", F.col("theme_id").alias("item"),
                  F.lit(None).cast("double").alias("weight"))
    b = tg.select("tag", F.lit("tg").alias("kind"), "rank", F.col("sim_tag").alias("item"), "weight")
    return a.unionByName(b)


def tag_index_nested(ls: DataFrame, tg: DataFrame) -> DataFrame:
    """Nested form, one row per tag: both bounded lists as arrays."""
    a = ls.groupBy("tag").agg(F.sort_array(F.collect_list(
        F.struct("rank", "theme_id", "grade", "quality", "ctime", "tokens"))).alias("ls"))
    b = tg.groupBy("tag").agg(F.sort_array(F.collect_list(F.struct("rank", "sim_tag", "weight"))).alias("tg"))
    return a.join(b, "tag")
