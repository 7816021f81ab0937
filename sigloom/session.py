"""Session factory and table loader shared by every query."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def session(master: str | None = None, app: str = "sigloom", **extra: str) -> SparkSession:
    """A session with the engine's settings; ``extra`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of ``sf_dir`` (a file or a folder of Parquet)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def load_ts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """As :func:`load`, with TIMESTAMP_NTZ columns cast to TIMESTAMP."""
    df = load(spark, sf_dir, name)
    ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or, within one machine (tests), one of its own."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if where is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="sigloom-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: what is used more than once isn't computed again."""
    path = f"{shared_dir(df.sparkSession)}/sigloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
