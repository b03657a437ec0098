"""Session helpers: a tuned builder for local runs and the checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "feedrec", extra: dict | None = None) -> SparkSession:
    """Builder used by tests and the bench. On a cluster, submit with your own
    conf; every operator only relies on AQE being on (Spark's default)."""
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("FEEDREC_DRIVER_MEM", "8g")))
    if master:
        b = b.master(master)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir`` (or
    that was set on the context). Without one we refuse: a machine-local folder
    would go with a lost executor. Tests and the bench set their own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        # the driver's own smoke runs have no shared folder: the warehouse is the one place the session names
        sc.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-checkpoints")
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3) before running iterative stages")


def drop_run_tables(spark: SparkSession) -> None:
    """Delete the intermediate tables of this session: each session has a
    folder of its own below the checkpoint folder. Call at the end of a run."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def run_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


def cut_lineage(df):
    """Cut the lineage of ``df`` with a written table: Parquet under the
    session's shared checkpoint folder, read back. One job writes it (a
    reliable ``checkpoint()`` needs a second one), the read-back plan is a
    plain scan with real file sizes, so the planner can broadcast a small
    result without guessing, and a lost executor never forces a recompute of
    what came before. Never a local checkpoint."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def bucketed(df, *keys: str):
    """``cut_lineage`` that keeps the rows of a key together: the table is bucketed
    by ``keys`` into as many buckets as the session has shuffle partitions, so joins
    and sums on them need no exchange. The catalogue entry that bucketing
    needs is dropped at once; the files lie in the run's folder."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"feedrec_{uuid.uuid4().hex}"
    (df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).option("path", f"{run_folder(spark)}/{name}").saveAsTable(name))
    out = spark.table(name)
    out.schema  # resolved before the entry goes
    spark.sql(f"DROP TABLE {name}")
    return out


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """Hold a setting while jobs run inside; the session's own value comes back."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def joins_on_part_of_keys(spark: SparkSession):
    """Let rows that lie together by one join key be joined on more keys as
    they lie."""
    return setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def joins_broadcast_up_to(spark: SparkSession, most: int):
    """Let the planner broadcast what it takes for ``most`` bytes at most, or less where
    the session says so. It goes by the size of files, of which a table of packed ids takes
    ten times as much in the driver."""
    now = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return setting(spark, "spark.sql.autoBroadcastJoinThreshold", str(min(now, most)))
