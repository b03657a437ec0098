"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import functools
import re
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrec.session import run_folder

#: Words are runs of anything but the six ASCII white-space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ASCII_UPPER = re.compile(r"[A-Z]+")


def smaller_batches(spark: SparkSession) -> None:
    """Texts can be long, so fewer of them and fewer bytes go to a Python worker at
    once, unless the session itself sets how many. The setting is read when a job
    starts, so it stays for the session."""
    given = spark.conf.getAll
    for key, value in (("maxRecordsPerBatch", "1000"), ("maxBytesPerBatch", "8m")):
        if f"spark.sql.execution.arrow.{key}" not in given:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", value)


def release() -> None:
    """Give memory that was freed back to the system, Arrow's and numpy's."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


#: What operators keep in a worker process between the tasks of their own stage.
kept: list[dict] = []


def forget() -> None:
    """Drop what operators of earlier stages keep in this worker."""
    if any(kept):
        for memo in kept:
            memo.clear()
        release()


def releasing(run: Callable) -> Callable:
    """A function over batches that finds little of other stages in its worker and
    leaves little behind when its task is done: the same workers run all stages."""
    @functools.wraps(run)  # pandas_udf reads the type hints
    def whole(batches: Iterator) -> Iterator:
        forget()
        yield from run(batches)
        release()  # what ``run`` held is gone by now

    return whole


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    smaller_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(text: str) -> str:
    """Lower-case A-Z only; other letters stay as they are."""
    if text.isascii():
        return text.lower()
    return _ASCII_UPPER.sub(lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(lower_ascii(text)) if text else []


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n. A null id falls in fold 0,
    the held-out one, so that it is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_scope: ContextVar[str] = ContextVar("scope", default="")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the run's folder, which ``drop_run_tables`` deletes."""
    return f"{run_folder(spark)}/llm/{_scope.get()}{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at the end."""
    before = _scope.get()
    inside = f"{before}scratch-{uuid.uuid4().hex}/"
    token = _scope.set(inside)
    try:
        yield
    finally:
        _scope.reset(token)
        drop_folder(spark, f"{run_folder(spark)}/llm/{inside}")


def store(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder and read it
    back. The table survives lost executors."""
    path = path or shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, bound: dict[int, int]) -> DataFrame:
    """Texts of a bounded, hash-ordered sample of labelled rows outside fold 0:
    at most ``bound[c]`` rows of class c. Labels given twice for an id count
    once, as the larger value. Returns (doc_id, text, y)."""
    keyed = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold(F.col("doc_id"), folds) != 0))
             .groupBy("doc_id").agg(F.max(F.col(label)).cast("int").alias("y")))
    parts = [keyed.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in bound.items()]
    picked = parts[0]
    for p in parts[1:]:
        picked = picked.unionByName(p)
    # at most sum(bound) ids of 8 bytes: a proven bound for the broadcast
    return (docs.select("doc_id", "text").where(fold(F.col("doc_id"), folds) != 0)
            .join(F.broadcast(picked), "doc_id")
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y"))
