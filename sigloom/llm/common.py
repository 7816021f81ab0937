"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space, everywhere in this folder.
WORD = r"[^\x20\x09-\x0D]+"


def strings(column: pa.Array) -> list[str]:
    """The column's values; null becomes the empty text."""
    out = column.to_pylist()
    return ["" if x is None else x for x in out] if column.null_count else out


def spans(lengths: np.ndarray, rows: int, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of at most ``rows`` rows and ``limit`` bytes, or of one row that is larger."""
    total = np.cumsum(lengths)
    at = 0
    while at < len(total):
        room = limit + (total[at - 1] if at else 0)
        end = max(at + 1, min(at + rows, int(np.searchsorted(total, room, side="right"))))
        yield at, end
        at = end


def sizes(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Bytes of each text."""
    found = pc.fill_null(pc.binary_length(column), 0)
    return found.to_numpy(zero_copy_only=False) if isinstance(found, pa.Array) else found.to_numpy()


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256, text: int | None = None, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches: at most ``rows`` rows and ``limit`` bytes of the column ``text``.

    What is worked on at once thus stays small where long texts follow each other too.
    """
    for batch in batches:
        if text is None:
            lengths = np.zeros(batch.num_rows, dtype=np.int64)
        else:
            lengths = sizes(batch.column(text)).astype(np.int64)
        for a, b in spans(lengths, rows, limit):
            yield batch.slice(a, b - a)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or, within one machine (tests), one of its own."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if where is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="sigloom-")
        spark.sparkContext.setCheckpointDir(where)
    return where


_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def written(df: DataFrame, what: str) -> DataFrame:
    """Cut lineage: write ``df`` once as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/sigloom/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(df))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def few_rows(df: DataFrame, most: int) -> DataFrame:
    """``df``, a written table of a few bytes a row, to be broadcast if it has ``most`` rows at most; joined as any other beyond."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(column, modulus: int):
    """crc32 of the value as text, modulo ``modulus``; of a null, that of the empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
