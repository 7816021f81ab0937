"""Candidate discovery: terms from requirements, matching, scores, merging and ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar, text
from .relational import containing, first_of, top_of

#: (category, weight) in the order in which a requirement's terms are taken.
BRANCHES = (
    ("actor", 0.5),
    ("threat_actor_tag", 0.3),
    ("notable_groups", 0.2),
    ("collection_focus", 0.2),
    ("asset_tag", 0.1),
    ("actor_alias", 0.5),
    ("description", 0.1),
)


def term_branches(pirs: DataFrame) -> DataFrame:
    """(pir_id, category, weight, prio, pos, raw) from requirement rows.

    pirs: pir_id, prioritized_actors array<struct<name, aliases>>, threat_actor_tags, notable_groups,
    collection_focus, asset_weight_rules array<struct<tag>>, description.
    """
    source = {
        "actor": F.transform("prioritized_actors", lambda a: a["name"]),
        "threat_actor_tag": F.col("threat_actor_tags"),
        "notable_groups": F.col("notable_groups"),
        "collection_focus": F.col("collection_focus"),
        "asset_tag": F.transform("asset_weight_rules", lambda r: r["tag"]),
        "actor_alias": F.flatten(F.transform("prioritized_actors", lambda a: F.coalesce(a["aliases"], F.array().cast("array<string>")))),
        "description": text.keywords(F.coalesce("description", F.lit(""))),
    }
    lists = F.array(
        *(
            F.struct(F.lit(c).alias("category"), F.lit(w).alias("weight"), F.lit(i).alias("prio"), source[c].cast("array<string>").alias("raws"))
            for i, (c, w) in enumerate(BRANCHES)
        )
    )
    return pirs.select("pir_id", F.inline(lists)).select("pir_id", "category", "weight", "prio", F.posexplode("raws").alias("pos", "raw"))


def build_terms(branches: DataFrame, most: int = 80) -> DataFrame:
    """(pir_id, term, category, weight): each term once per requirement, the first ``most`` in order."""
    terms = branches.withColumn("term", text.term("raw")).where("term is not null")
    once = first_of(terms, ["pir_id", "term"], "prio", "pos")
    return top_of(once, ["pir_id"], most, "prio", "pos").select("pir_id", "term", "category", "weight")


def in_window(published: Column | str, start: Column, end: Column) -> Column:
    """Whether a time is within the window; rows without one are."""
    p = F.col(published) if isinstance(published, str) else published
    return p.isNull() | p.between(F.to_timestamp(start), scalar.window_end(end))


def match_terms(entries: DataFrame, terms: DataFrame, body: str = "body", title: str = "title") -> DataFrame:
    """Entries x terms that they hold: entry columns, pir_id, term, weight, in_title.

    Each text is normalised once, before it meets the terms. See ``relational.containing``: few
    terms (80 per requirement at most) are tried beside the scan, without a shuffle; many are
    joined by their first letters. Only matches become rows.
    """
    normal = entries.withColumn("_h", text.plain_text(body)).withColumn("_t", text.plain_text(F.coalesce(title, F.lit(""))))
    wanted = terms.select("pir_id", "term", "weight", text.plain_text("term").alias("_n"))
    joined = containing(normal, "_h", wanted, "_n")
    return joined.withColumn("in_title", F.contains("_t", "_n")).drop("_h", "_t", "_n")


def score(matches: DataFrame, keys: list[str], published: str, start: Column, end: Column, digits: int = 3) -> DataFrame:
    """One row per entry: its score, and the requirements and terms that it met, sorted."""
    total = F.sum(F.col("weight") + F.when(F.col("in_title"), 0.2).otherwise(0.0))
    bonus = scalar.recency_bonus(F.col(published), F.to_timestamp(start), scalar.window_end(end))
    return (
        matches.groupBy(*keys, published)
        .agg(
            total.alias("_sum"),
            F.array_sort(F.collect_set("pir_id")).alias("matched_pir_ids"),
            F.array_sort(F.collect_set("term")).alias("matched_terms"),
        )
        .withColumn("score", F.round(F.least(F.lit(1.0), F.col("_sum") + bonus), digits))
        .drop("_sum")
    )


def merge(candidates: DataFrame, key: Column, carried: list[str], order: str) -> DataFrame:
    """One row per URL key: the row with the higher score (the earlier one of equals), ids and terms united."""
    best = F.struct("score", (-F.col(order)).alias("_early"))
    return (
        candidates.withColumn("url_key", key)
        .groupBy("url_key")
        .agg(
            F.max("score").alias("score"),
            *(F.max_by(c, best).alias(c) for c in carried),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("matched_pir_ids")))).alias("matched_pir_ids"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("matched_terms")))).alias("matched_terms"),
            F.min(order).alias(order),
        )
    )


def rank(candidates: DataFrame, most: int, recent: DataFrame | None = None) -> DataFrame:
    """The best ``most`` by score, time and title; ``recent`` rows (score 0) fill what is left.

    Both need url_key, score, published_at, title, ord. Ends in one TakeOrderedAndProject.
    """
    ranked = candidates.withColumn("bucket", F.lit(0))
    if recent is not None:
        more = recent.join(candidates.select("url_key"), "url_key", "left_anti").withColumn("bucket", F.lit(1))
        ranked = ranked.unionByName(more, allowMissingColumns=True)
    never = F.lit("0001-01-01 00:00:00").cast("timestamp")
    return ranked.orderBy(
        "bucket", F.desc("score"), F.desc(F.coalesce("published_at", never)), F.desc(F.coalesce("title", F.lit(""))), "ord"
    ).limit(max(0, most))


def counters(entries: DataFrame, matched: DataFrame, source: str = "source") -> DataFrame:
    """Entries, those in the window and those matched, per source and in all (source null)."""
    both = entries.select(source, F.lit(1).alias("e"), F.col("in_window").cast("int").alias("w"), F.lit(0).alias("m")).unionByName(
        matched.select(source, F.lit(0).alias("e"), F.lit(0).alias("w"), F.lit(1).alias("m"))
    )
    return both.rollup(source).agg(F.sum("e").alias("entries"), F.sum("w").alias("in_window"), F.sum("m").alias("matched"))
