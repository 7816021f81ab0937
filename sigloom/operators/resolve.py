"""Resolution of free-form references against inventories, by tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .relational import FEW_NEEDLES, containing

CONFIDENCE = {1: 80, 2: 50, 3: 30}
MIN_OVERLAP = 4


def _overlapping(refs: DataFrame, names: DataFrame, few: int = FEW_NEEDLES) -> DataFrame:
    """References (_r) with names (_n) where one holds the other, 4 characters or more."""
    n = names.where(F.length("_n") >= MIN_OVERLAP)
    held = containing(refs, "_r", n, "_n", MIN_OVERLAP, few)
    holds = containing(n, "_n", refs, "_r", MIN_OVERLAP, few)
    return held.unionByName(holds).distinct()


def _decide(hits: DataFrame, ref: str) -> DataFrame:
    """The best tier of a reference decides; more than one hit in it is ambiguous and resolves to nothing."""
    per_tier = hits.groupBy(ref, "tier").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    best = per_tier.groupBy(ref).agg(F.min_by(F.struct("tier", "n", "id"), "tier").alias("b"))
    confidence = F.create_map(*(F.lit(x) for kv in CONFIDENCE.items() for x in kv))
    return best.where("b.n = 1").select(ref, F.col("b.id").alias("id"), F.col("b.tier").alias("tier"), confidence[F.col("b.tier")].alias("confidence"))


def resolve_assets(references: DataFrame, assets: DataFrame, ref: str = "reference") -> DataFrame:
    """(reference, id, tier, confidence). Tiers: equal name, name overlap of 4 characters or more, equal tag.

    assets: id, name, tags. Each distinct reference is resolved once. Equal names and tags are
    equi-joins; only references without an equal name meet the names by substring
    (``relational.containing``).
    """
    refs = references.select(F.col(ref)).where(text.strip(ref) != "").distinct().withColumn("_r", text.normal(ref))
    names = assets.select("id", text.normal(F.coalesce("name", F.lit(""))).alias("_n"), "tags")
    equal = refs.join(names.select("id", F.col("_n").alias("_r")), "_r").select(ref, "id", F.lit(1).alias("tier"))
    rest = refs.join(equal.select(ref).distinct(), ref, "left_anti")
    over = _overlapping(rest, names.select("id", "_n")).select(ref, "id", F.lit(2).alias("tier")).distinct()
    tags = names.select("id", F.explode("tags").alias("t")).select("id", text.normal("t").alias("_r")).distinct()
    tagged = rest.join(tags, "_r").select(ref, "id", F.lit(3).alias("tier"))
    return _decide(equal.unionByName(over).unionByName(tagged), ref)


def resolve_identities(references: DataFrame, identities: DataFrame, ref: str = "reference") -> DataFrame:
    """As :func:`resolve_assets`; the third tier is a reference within any role or sector.

    identities: id, name, roles, sectors.
    """
    refs = references.select(F.col(ref)).where(text.strip(ref) != "").distinct().withColumn("_r", text.normal(ref))
    none = F.array().cast("array<string>")
    rows = identities.select(
        "id",
        text.normal(F.coalesce("name", F.lit(""))).alias("_n"),
        F.transform(F.filter(F.concat(F.coalesce("roles", none), F.coalesce("sectors", none)), lambda f: f.isNotNull()), F.lower).alias("_f"),
    )
    equal = refs.join(rows.select("id", F.col("_n").alias("_r")), "_r").select(ref, "id", F.lit(1).alias("tier"))
    rest = refs.join(equal.select(ref).distinct(), ref, "left_anti")
    over = _overlapping(rest, rows.select("id", "_n")).select(ref, "id", F.lit(2).alias("tier")).distinct()
    fields = rows.select("id", F.explode(F.array_distinct("_f")).alias("_field"))
    # A role or sector may hold a reference of any length.
    within = containing(fields, "_field", rest, "_r", 1).select(ref, "id", F.lit(3).alias("tier")).distinct()
    # A reference's third-tier hits include names that the second tier has; the best tier decides anyway.
    return _decide(equal.unionByName(over).unionByName(within), ref)
