"""Crawl state and caches: keyed tables that runs read, compare with and replace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar

STATE = (
    "url string, first_seen string, last_seen string, content_sha256 string, bundle_path string, "
    "relevance struct<decision:string,score:double,matched_pir_ids:array<string>,rationale:string,pir_set_hash:string>, "
    "iocs array<struct<type:string,value:string,confidence:double,context_snippet:string>>"
)


def changed(fetched: DataFrame, state: DataFrame, pir_set_hash: str | None = None, recheck: bool = False) -> DataFrame:
    """``fetched`` (url, content_sha256 ...) with ``unchanged``: the stored hash is equal and, with ``recheck``, so is the requirements' hash."""
    old = state.select("url", F.col("content_sha256").alias("_sha"), F.col("relevance.pir_set_hash").alias("_pir"))
    same = F.col("_sha").eqNullSafe(F.col("content_sha256")) & F.col("_sha").isNotNull()
    if recheck:
        same = same & F.col("_pir").eqNullSafe(F.lit(pir_set_hash))
    return fetched.join(old, "url", "left").withColumn("unchanged", F.coalesce(same, F.lit(False))).drop("_sha", "_pir")


def upsert(state: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """The state after a run: rows of ``updates`` replace those of their URL but keep ``first_seen``; other rows stay.

    One full outer join on the key; both sides are partitioned by it once.
    """
    stamp = scalar.wire_time(now)
    values = [c for c in state.columns if c not in ("url", "first_seen", "last_seen")]
    new = updates.select("url", F.struct(*values).alias("_new"))
    old = state.select("url", F.struct("first_seen", "last_seen", *values).alias("_old"))
    joined = old.join(new, "url", "full_outer")
    hit = F.col("_new").isNotNull()
    return joined.select(
        "url",
        F.coalesce("_old.first_seen", stamp).alias("first_seen"),
        F.when(hit, stamp).otherwise(F.col("_old.last_seen")).alias("last_seen"),
        *(F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in values),
    )


def ioc_index(state: DataFrame) -> DataFrame:
    """One row per indicator of the state; entries without any have none."""
    return state.select("url", "first_seen", "last_seen", "bundle_path", F.col("relevance.score").alias("relevance_score"), F.inline("iocs"))


def outcomes(processed: DataFrame, kinds: list[str], kind: str = "kind") -> DataFrame:
    """Rows per outcome, those without any as 0."""
    known = processed.sparkSession.createDataFrame([(k,) for k in kinds], f"{kind} string")
    return F.broadcast(known).join(processed.groupBy(kind).agg(F.count(F.lit(1)).alias("n")), kind, "left").fillna(0, ["n"])


def without_unchanged(processed: DataFrame, kind: str = "kind") -> DataFrame:
    """Outcomes but those that were skipped as unchanged."""
    return processed.where(F.col(kind) != "skipped_unchanged")


# --- hash cache -------------------------------------------------------------------------------


def fresh(fetched_at: Column | str, now: Column, ttl_days: int) -> Column:
    """Whether a cache entry is young enough; what isn't a time is stale."""
    at = F.col(fetched_at) if isinstance(fetched_at, str) else fetched_at
    return F.coalesce(F.try_to_timestamp(at) >= now - F.make_interval(days=F.lit(ttl_days)), F.lit(False))


def with_hashes(refs: DataFrame, cache: DataFrame, fetched: DataFrame | None, now: Column, ttl_days: int = 30) -> tuple[DataFrame, DataFrame]:
    """References (url ...) with ``sha256`` from fresh entries or from ``fetched`` (url, sha256), and the new cache.

    A failed fetch (a null hash) is cached too, and not tried again until its time is up.
    """
    live = cache.where(fresh("fetched_at", now, ttl_days))
    wanted = refs.select("url").where("url is not null").distinct().join(live, "url", "left_anti")
    stamp = scalar.wire_time(now)
    new = wanted.join(fetched.select("url", "sha256"), "url", "left") if fetched is not None else wanted.withColumn("sha256", F.lit(None).cast("string"))
    new = new.select("url", "sha256", stamp.alias("fetched_at"), F.when(F.col("sha256").isNull(), "failed").otherwise("ok").alias("status"))
    stale = cache.join(new.select("url"), "url", "left_anti")
    after = stale.unionByName(new)
    return refs.join(after.where("status = 'ok'").select("url", "sha256"), "url", "left"), after
