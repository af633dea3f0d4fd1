"""Session settings the library counts on, and scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Dates and times are those of UTC wherever the cluster stands.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``.

    A local session is one machine and gets a local folder where none is named; a
    cluster must name one, since a folder of one machine would lose the other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="termtide-"))
    return spark.conf.get("spark.checkpoint.dir")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a table in the shared folder that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: read back, never computed again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # Parquet has no column without a type.
    untyped = [c for c, kind in df.dtypes if kind == "void"]
    df.drop(*untyped).write.parquet(path, compression=codec)
    found = spark.read.schema(df.drop(*untyped).schema).parquet(path)
    return found.withColumns({c: F.lit(None) for c in untyped}).select(*(f"`{c}`" for c in df.columns))


def numbered_rows(df: DataFrame, name: str, number: str = "_row") -> DataFrame:
    """``df`` stored once, every row with a number of its own."""
    return stored(df.withColumn(number, F.monotonically_increasing_id()), name)
