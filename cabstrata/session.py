"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: str = "*", app: str = "cabstrata", **conf: str) -> SparkSession:
    """A session on this machine, for tests, the bench and the command line."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    local = {"spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": "8"}
    for k, v in (CONF | local | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's spark.checkpoint.dir. A session on one machine
    without that setting (tests) gets a folder of its own; on a cluster a machine's own folder would lose
    what other machines write to theirs, so that is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        have = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = have.get() if have.isDefined() else None
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        d = tempfile.mkdtemp(prefix="cabstrata-")
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. It is deleted when the session's JVM ends: tables that are read
    lazily can't be let go before."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives the
    loss of executors, and is a fraction of the size of an RDD checkpoint."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
