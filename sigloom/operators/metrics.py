"""Run metrics: event logs folded into one row per run, and totals over runs."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import scalar

#: name, event, field, fold: last (the last value wins), sum, max, any (the event occurred), count
FOLDS = (
    ("input_chars", "url_converted", "chars", "last"),
    ("body_chars", "url_converted", "body_chars", "last"),
    ("l2_score", "relevance_call_done", "score", "last"),
    ("l2_failed", "relevance_call_failed", None, "any"),
    ("l3_chunks", "extracting_entities_chunked", "chunks", "last"),
    ("l3_parse_failures", "extraction_response_not_object", None, "count"),
    ("raw_entities", "extractions_merged", "raw_entities", "last"),
    ("merged_entities", "extractions_merged", "merged_entities", "last"),
    ("llm_calls", "llm_call_done", None, "count"),
    ("llm_output_chars", "llm_call_done", "chars", "sum"),
    ("indicators_dropped", "indicator_dropped_invalid_pattern", None, "count"),
    ("relationships_unresolved", "stix_relationships_dropped", "count", "sum"),
    ("relationships_mismatched", "stix_relationships_type_mismatch_dropped", "count", "sum"),
    ("refs_hashed", "external_ref_hashed", None, "count"),
    ("refs_failed", "external_ref_fetch_failed", None, "count"),
    ("bundle_objects", "stix_bundle_written", "object_count", "last"),
)


def fold(events: DataFrame, folds=FOLDS, run: str = "run_id", seq: str = "seq", event: str = "event", payload: str = "payload") -> DataFrame:
    """One row per run from (run, seq, event, payload as JSON): a single aggregation with a filter per metric."""
    out = []
    for name, what, field, how in folds:
        hit = F.col(event) == what
        value = F.get_json_object(payload, f"$.{field}").try_cast("double") if field else F.lit(1.0)
        one = F.when(hit, value)
        out.append(
            {
                "last": F.max_by(one, F.when(hit & value.isNotNull(), F.col(seq))),
                "sum": F.coalesce(F.sum(one), F.lit(0.0)),
                "max": F.max(one),
                "any": F.coalesce(F.bool_or(hit), F.lit(False)),
                "count": F.count_if(hit),
            }[how].alias(name)
        )
    return events.groupBy(run).agg(*out)


def per_tier(events: DataFrame, run: str = "run_id") -> DataFrame:
    """Calls and output characters of each run and tier; tiers that only started show zeros."""
    tier = F.coalesce(F.get_json_object("payload", "$.task"), F.lit("unknown"))
    chars = F.coalesce(F.get_json_object("payload", "$.chars").try_cast("long"), F.lit(0))
    done = F.col("event") == "llm_call_done"
    return (
        events.where(F.col("event").isin("llm_call_start", "llm_call_done"))
        .groupBy(run, tier.alias("tier"))
        .agg(F.count_if(done).alias("calls"), F.sum(F.when(done, chars).otherwise(0)).alias("output_chars"))
    )


def batch_totals(runs: DataFrame, sums: list[str], started: str = "started_at") -> DataFrame:
    return runs.agg(F.count(F.lit(1)).alias("runs"), F.min(started).alias("started_at"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums))


def drop_counts(kept: DataFrame, dropped: DataFrame, by: list[str]) -> DataFrame:
    """Rows kept and dropped, by reason: drops are data, so counters are an aggregation."""
    return kept.select(*by, F.lit("kept").alias("reason")).unionByName(dropped.select(*by, "reason")).groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("n"))


class RunLog:
    """The life of runs on the driver: each event is a row (run_id, seq, event, payload) for :func:`fold`.

    A run is an id, not a thread; several may be open at once.
    """

    def __init__(self, now: Callable[[], str]):
        self.now, self.rows, self.open = now, [], {}

    def start(self, run_id: str, **payload) -> Callable[..., None]:
        """Begin a run; what is returned logs its events."""
        if run_id in self.open:
            raise ValueError(f"run {run_id} has begun already")
        self.open[run_id] = 0
        self._add(run_id, "run_started", {"at": self.now(), **payload})
        return lambda event, **more: self._add(run_id, event, more)

    def finish(self, run_id: str, **payload) -> None:
        self._add(run_id, "run_finished", {"at": self.now(), **payload})
        del self.open[run_id]

    def _add(self, run_id: str, event: str, payload: dict) -> None:
        if run_id not in self.open:
            raise ValueError(f"run {run_id} isn't open")
        self.open[run_id] += 1
        self.rows.append((run_id, self.open[run_id], event, json.dumps(payload)))

    def events(self, spark) -> DataFrame:
        return spark.createDataFrame(self.rows, "run_id string, seq int, event string, payload string")


def durations(events: DataFrame, run: str = "run_id") -> DataFrame:
    """Seconds from the start to the end of each run; null while it is open."""
    at = lambda what: F.max(F.when(F.col("event") == what, F.try_to_timestamp(F.get_json_object("payload", "$.at"))))
    times = events.groupBy(run).agg(at("run_started").alias("_s"), at("run_finished").alias("_e"))
    return times.select(run, scalar.seconds_between("_s", "_e").alias("seconds"))


def watched(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """``df`` with measures taken while it is computed, and where they can be read afterwards."""
    seen = Observation(name)
    return df.observe(seen, *(c.alias(k) for k, c in measures.items())), seen


def summary(row) -> str:
    """Lines for people from one folded row."""
    return "\n".join(f"{k.replace('_', ' '):<28}{v}" for k, v in row.asDict().items() if v is not None)


__all__ = ["FOLDS", "RunLog", "batch_totals", "drop_counts", "durations", "fold", "per_tier", "summary", "watched"]
