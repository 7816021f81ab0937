"""Streams give what a batch over the same rows gives."""

from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sigloom.operators.relational import first_of
from sigloom.streaming import crawl

START = datetime(2026, 1, 1)


def written(spark, path, rows):
    df = spark.createDataFrame(rows, "id long, at timestamp, kind string")
    df.coalesce(1).write.mode("append").parquet(path)


def test_state_over_two_runs_equals_one_batch(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(i % 3, START + timedelta(minutes=7 * i), "ab"[i // 4 % 2]) for i in range(24)]

    def run():
        stream = spark.readStream.schema("id long, at timestamp, kind string").parquet(path)

        def each(batch, number):
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/b={number}")

        crawl.run_available(crawl.latest_by_key(stream, "id", "at", "kind"), each, str(tmp_path / "c"))

    written(spark, path, rows[:11])
    run()
    written(spark, path, rows[11:])
    run()
    last = {r["key"]: r for r in first_of(spark.read.parquet(out), ["key"], F.desc("batch")).collect()}
    for k in range(3):
        own = [r for r in rows if r[0] == k]
        changes = sum(a[2] != b for a, b in zip(own, [None, *(r[2] for r in own)]))
        r = last[str(k)]
        assert (r["first_seen"], r["last_seen"], r["content"], r["versions"]) == (own[0][1], own[-1][1], own[-1][2], changes)


def test_windowed_counts(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [(i, START + timedelta(minutes=17 * i), "ab"[i % 2]) for i in range(20)]
    written(spark, path, rows)
    stream = spark.readStream.schema("id long, at timestamp, kind string").parquet(path)
    got: list = []
    crawl.run_available(crawl.windowed_counts(stream, "at", "kind"), lambda b, n: got.extend(b.collect()), str(tmp_path / "c"), "complete")
    want = Counter((r[1].replace(minute=0), r[2]) for r in rows)
    assert {(r["start"], r["kind"]): r["n"] for r in got[-len(want) :]} == want
