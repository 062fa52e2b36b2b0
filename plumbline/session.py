"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(cpus: str | int = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that the queries are written for."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("plumbline")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    share_code(spark)
    return spark


def share_code(spark: SparkSession) -> None:
    """Let Python workers find this package by the path that it has here, whatever the working folder. Where machines
    don't share that path, ship the package with --py-files."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if here not in known:
        env["PYTHONPATH"] = os.pathsep.join([here, *filter(None, known)])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; only where that is unset, one of our own (tests), which a
    cluster could not share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = jdir.get() if jdir.isDefined() else None
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="plumbline-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, survives lost executors, and makes
    results of sampling or range partitioning stable. The files go when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/plumbline/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath.getParent())
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """The right side of a join of which both sides grow with the input: sorted and merged, never gathered in the driver.
    Spark can't tell such sides from small ones: it goes by the compressed bytes of files and doesn't count what explode adds."""
    return df.hint("merge")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
