"""Relevance verdicts, the gate, and indicators of compromise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import jsontext, scalar, text

VERDICT = "struct<score:string,matched_pir_ids:array<string>,rationale:string>"
READ = "struct<score:double,matched_pir_ids:array<string>,rationale:string,failed:boolean,salvaged:boolean>"
IOC = "array<struct<type:string,value:string,confidence:double,context_snippet:string>>"


def verdict(raw: Column | str) -> Column:
    """struct<score, matched_pir_ids, rationale, failed, salvaged> of a response; ``failed`` if nothing can be read."""
    x = F.col(raw) if isinstance(raw, str) else raw
    whole, part = F.from_json(jsontext.ladder(x), VERDICT), jsontext.partial_verdict(x)
    read = whole["score"].isNotNull() | whole["matched_pir_ids"].isNotNull() | whole["rationale"].isNotNull()
    none = F.array().cast("array<string>")
    return F.struct(
        F.when(read, scalar.clamped(whole["score"])).otherwise(F.coalesce(scalar.clamped(part["score"]), F.lit(0.0))).alias("score"),
        F.coalesce(F.when(read, whole["matched_pir_ids"]).otherwise(part["matched_pir_ids"]), none).alias("matched_pir_ids"),
        F.coalesce(F.when(read, F.substring(text.strip(whole["rationale"]), 1, 200)), F.when(part.isNotNull(), "(truncated)"), F.lit("")).alias("rationale"),
        (~F.coalesce(read, F.lit(False)) & part.isNull()).alias("failed"),
        (~F.coalesce(read, F.lit(False)) & part.isNotNull()).alias("salvaged"),
    )


def keeps(score: Column, failed: Column, threshold: float) -> Column:
    """Rows at the threshold or above, and those whose verdict failed (the gate fails open)."""
    return F.coalesce(failed, F.lit(False)) | (score >= threshold)


def boosted(score: Column, failed: Column, body: Column, names: list[str], boost: float = 0.2) -> Column:
    """The score, raised once if the text names any of ``names``; never above 1, not for failed verdicts."""
    low = F.lower(body)
    named = F.lit(False)
    for name in names:
        if name.strip():
            named = named | F.contains(low, F.lower(F.lit(name.strip())))
    return F.when(F.coalesce(named, F.lit(False)) & ~failed, F.least(F.lit(1.0), score + boost)).otherwise(score)


def high_value_names(identities: DataFrame) -> DataFrame:
    """(name) of the identities that are marked as targets of impersonation."""
    return identities.where("is_high_value_impersonation_target").select(text.strip("name").alias("name")).where("name <> ''").distinct()


def contexts(sources: DataFrame, pirs: DataFrame, everything: Column, short: Column) -> DataFrame:
    """(pir_ids, context): for each set of requirements that sources are restricted to, their short forms as a JSON list.

    The empty set stands for all of them (``everything``). A set's members are joined by id.
    """
    sets = sources.select(F.coalesce("pir_ids", F.array().cast("array<string>")).alias("pir_ids")).distinct()
    some = sets.select("pir_ids", F.explode(F.array_distinct("pir_ids")).alias("pir_id")).join(pirs.select("pir_id", "pos", short.alias("s")), "pir_id")
    listed = some.groupBy("pir_ids").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda x: x["s"])).alias("context"))
    return sets.join(listed, "pir_ids", "left").withColumn("context", F.when(F.size("pir_ids") == 0, everything).otherwise(F.coalesce("context", F.lit("[]"))))


def iocs(responses: DataFrame, json_col: str = "json", url: str = "url") -> DataFrame:
    """Valid indicators, one per row: known type, a value of 1 to 512 characters, confidence in [0, 1], no other keys.

    Entries that aren't are dropped one by one. Output: url, pos, type, value, confidence, context_snippet.
    """
    items = responses.select(url, F.explode(F.array(F.try_parse_json(json_col))).alias("v")).select(
        url, F.posexplode(F.try_variant_get("v", "$.iocs", "array<variant>")).alias("pos", "item")
    )
    typed = items.select(
        url,
        "pos",
        F.try_variant_get("item", "$.type", "string").alias("type"),
        text.strip(F.try_variant_get("item", "$.value", "string")).alias("value"),
        F.try_variant_get("item", "$.confidence", "double").alias("confidence"),
        text.snippet(F.coalesce(F.try_variant_get("item", "$.context_snippet", "string"), F.lit(""))).alias("context_snippet"),
        F.map_keys(F.from_json(F.to_json("item"), "map<string,string>")).alias("_keys"),
    )
    allowed = F.array(*(F.lit(k) for k in ("type", "value", "confidence", "context_snippet")))
    return typed.where(
        F.col("type").isin(*vocab.IOC_TYPES)
        & F.length("value").between(1, 512)
        & F.col("confidence").between(0.0, 1.0)
        & (F.size(F.array_except("_keys", allowed)) == 0)
    ).drop("_keys")


def search(index: DataFrame, bundle_tlp: DataFrame, ioc: str, tlp_max: str = "amber", kind: str | None = None) -> DataFrame:
    """Rows of the index whose value equals ``ioc`` (case and outer space aside) and whose bundle may be seen.

    index: url, bundle_path, type, value and more; bundle_tlp: bundle_path, tlp. A bundle without a
    marking is clear.
    """
    hit = text.normal("value") == text.normal(F.lit(ioc))
    if kind:
        hit = hit & (F.col("type") == kind)
    found = index.where(hit).join(bundle_tlp, "bundle_path", "left").withColumn("tlp", F.coalesce("tlp", F.lit("clear")))
    return found.where(scalar.rank_of("tlp") <= scalar.rank_of(F.lit(tlp_max)))


def bundle_tlp(marks: DataFrame, bundle: str = "bundle_path", ref: str = "marking_ref") -> DataFrame:
    """The strictest level of each bundle's markings (bundle and objects); unknown markings don't count."""
    levels = F.create_map(*(F.lit(x) for kv in vocab.TLP_MARKINGS.items() for x in kv))
    rank = scalar.rank_of(levels[F.col(ref)])
    return marks.groupBy(bundle).agg(F.coalesce(scalar.level_of(F.max(rank)), F.lit("clear")).alias("tlp"))
