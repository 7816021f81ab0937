"""Shapes that several operators share: first of a key, size-checked broadcast, salted joins."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows, and bytes of them, up to which a side may be broadcast by hand; beyond either Catalyst chooses.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32 << 20
#: Needles that are tried one by one; bytes of needles that one automaton holds.
FEW_NEEDLES, NEEDLE_BYTES = 64, 32 << 20


def first_of(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in a total order (``dropDuplicates`` would keep any)."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def top_of(df: DataFrame, keys: list[str], n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows of each key; Catalyst limits each group before the shuffle."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).where(F.col("_nth") <= n).drop("_nth")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, hinted for broadcast if a bounded look at it shows that it is small in rows and bytes; else as it is."""
    return F.broadcast(df) if is_small(df, rows) else df


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether there are ``rows`` rows at most, and ``size`` bytes of them written as JSON."""
    n, total = df.select(F.octet_length(F.to_json(F.struct(*df.columns))).alias("b")).limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return n <= rows and total <= size


def _finder(needles: list[str]):
    """A function of the executors: the needles (as places in the list) that each text holds, in one pass over it."""

    def machine():
        import ahocorasick

        out = ahocorasick.Automaton()
        for i, needle in enumerate(needles):
            out.add_word(needle, i)
        out.make_automaton()
        return out

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = machine()
        for batch in batches:
            yield pd.Series([[needles[i] for i in dict.fromkeys(i for _, i in own.iter(t))] if isinstance(t, str) else [] for t in batch], dtype=object)

    return F.pandas_udf(run, T.ArrayType(T.StringType()))


def containing(texts: DataFrame, text: str, needles: DataFrame, needle: str, least: int = 3, few: int = FEW_NEEDLES, block_bytes: int = NEEDLE_BYTES) -> DataFrame:
    """Rows of ``texts`` with those of ``needles`` that their text holds; needles of less than ``least`` characters match nothing.

    Up to ``few`` needles (a bounded count tells) are broadcast and tried on each text beside its
    scan. More are searched all at once, by an automaton in one pass over each text, and joined by
    their strings: a text is copied once per match, never before. Needles beyond ``block_bytes``
    are taken in blocks of at most so many bytes, one pass over the texts each.
    """
    long = needles.where(F.length(needle) >= least)
    if is_small(long, few):
        return texts.join(F.broadcast(long), F.contains(text, needle))
    different = long.select(F.col(needle).alias("_hit")).distinct()
    size = different.agg(F.sum(F.octet_length("_hit"))).first()[0]
    blocks = max(1, -(-(size or 0) * 5 // (block_bytes * 4))) if (size or 0) > block_bytes else 1
    found = []
    for block in range(blocks):
        own = [r["_hit"] for r in different.where(F.pmod(F.xxhash64("_hit"), F.lit(blocks)) == block).collect()]  # bounded by the block
        if own:
            hits = texts.withColumn("_hits", _finder(own)(F.col(text))).where(F.size("_hits") > 0)
            found.append(hits.withColumn("_hit", F.explode("_hits")).drop("_hits"))
    if not found:
        return texts.join(long.limit(0), F.contains(text, needle))
    keyed = reduce(DataFrame.unionByName, found)
    return keyed.join(long.withColumn("_hit", F.col(needle)), "_hit").drop("_hit")


def counted_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur twice or more, with ``n``. Two-phase aggregation, so hot keys don't skew it."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
