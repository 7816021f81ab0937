"""From model responses to merged entities and relationships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text
from .relational import first_of

ENTITY = (
    "array<struct<local_id:string,type:string,name:string,description:string,pattern:string,pattern_type:string,labels:array<string>,"
    "aliases:array<string>,malware_types:array<string>,tool_types:array<string>,"
    "kill_chain_phases:array<struct<kill_chain_name:string,phase_name:string>>,"
    "external_references:array<struct<source_name:string,external_id:string,url:string>>,identity_class:string,sectors:array<string>,"
    "primary_motivation:string,secondary_motivations:array<string>,sophistication:string,is_family:boolean,valid_from:string>>"
)
RESPONSE = (
    f"struct<entities:{ENTITY},relationships:array<struct<source:string,target:string,relationship_type:string>>,"
    "identity_asset_edges:array<struct<source:string,asset_reference:string,description:string>>,"
    "user_account_observations:array<struct<account_login:string,display_name:string,account_type:string,is_privileged:boolean,"
    "is_service_account:boolean,identity_local_id:string,asset_references:array<string>>>,"
    "identity_relationship_edges:array<struct<source:string,relationship_type:string,target_identity_reference:string,confidence:int,description:string>>>"
)
LISTS = ("labels", "aliases", "malware_types", "tool_types", "kill_chain_phases", "external_references")


def parsed(responses: DataFrame, json_col: str = "json") -> DataFrame:
    """Responses (doc_id, chunk, json) with the typed struct ``x``."""
    return responses.withColumn("x", F.from_json(json_col, RESPONSE))


def alias(chunk, local_id) -> Column:
    """Ids of different chunks of a document never meet."""
    return F.concat(F.lit("c"), F.col(chunk).cast("string"), F.lit("_"), local_id)


def entities(responses: DataFrame) -> DataFrame:
    """Entities of known types that have an id: (doc_id, chunk, ord, alias, type, properties ...)."""
    e = responses.select("doc_id", "chunk", F.posexplode("x.entities").alias("ord", "e")).select("doc_id", "chunk", "ord", "e.*")
    return e.where(F.col("type").isin(*vocab.ENTITY_TYPES) & (F.col("local_id") != "")).withColumn("alias", alias("chunk", F.col("local_id"))).drop("local_id")


def relationships(responses: DataFrame) -> DataFrame:
    r = responses.select("doc_id", "chunk", F.posexplode("x.relationships").alias("ord", "r")).select("doc_id", "chunk", "ord", "r.*")
    known = F.col("relationship_type").isin(*vocab.RELATIONSHIP_TYPES)
    return r.where(known & (F.col("source") != "") & (F.col("target") != "")).withColumns(
        {"source": alias("chunk", F.col("source")), "target": alias("chunk", F.col("target"))}
    )


def asset_edges(responses: DataFrame) -> DataFrame:
    e = responses.select("doc_id", "chunk", F.posexplode("x.identity_asset_edges").alias("ord", "e")).select("doc_id", "chunk", "ord", "e.*")
    return e.where((text.strip("source") != "") & (text.strip("asset_reference") != "")).withColumn("source", alias("chunk", F.col("source")))


def identity_edges(responses: DataFrame) -> DataFrame:
    e = responses.select("doc_id", "chunk", F.posexplode("x.identity_relationship_edges").alias("ord", "e")).select("doc_id", "chunk", "ord", "e.*")
    known = F.col("relationship_type").isin("attributed-to", "impersonates")
    return e.where(known & (text.strip("target_identity_reference") != "")).withColumn("source", alias("chunk", F.col("source")))


def accounts(responses: DataFrame) -> DataFrame:
    a = responses.select("doc_id", "chunk", F.posexplode("x.user_account_observations").alias("ord", "a")).select("doc_id", "chunk", "ord", "a.*")
    return a.withColumn("account_login", text.strip("account_login")).where("account_login <> ''").withColumns(
        {
            "account_type": F.when(F.col("account_type").isin(*vocab.ACCOUNT_TYPES), F.col("account_type")).otherwise(""),
            "display_name": F.coalesce(text.strip("display_name"), F.lit("")),
            "is_privileged": F.coalesce("is_privileged", F.lit(False)),
            "is_service_account": F.coalesce("is_service_account", F.lit(False)),
            "identity_local_id": F.when(F.col("identity_local_id") != "", alias("chunk", F.col("identity_local_id"))).otherwise(""),
            "asset_references": F.filter(
                F.transform(F.coalesce("asset_references", F.array().cast("array<string>")), text.strip), lambda r: r != ""
            ),
        }
    )


def merge_key(kind, name, pattern) -> Column:
    """Entities of a document that share it are one: patterns of indicators, else lower-cased names."""
    by_pattern, by_name = F.nullif(text.strip(pattern), F.lit("")), F.nullif(text.normal(name), F.lit(""))
    return F.when(F.col(kind) == "indicator", by_pattern).otherwise(by_name)


def merge_entities(ents: DataFrame, scalars: list[str], lists: list[str], doc: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Merged entities and the map (doc_id, alias, canonical).

    The first entity of a key (by chunk, then place) gives the id, the first that has a scalar gives
    that, lists are united in order of appearance. Entities without a key stay as they are.
    ents: doc, chunk, ord, alias, type, name, pattern and the columns named.
    """
    at = F.struct("chunk", "ord")
    key = F.coalesce(F.concat(F.lit("k:"), merge_key("type", "name", "pattern")), F.concat(F.lit("a:"), F.col("alias")))
    keyed = ents.withColumn("_key", key).withColumn("_at", at)

    def united(c: str) -> Column:
        rows = F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("_at", F.col(c).alias("v")))))
        return F.array_distinct(F.flatten(F.transform(rows, lambda r: r["v"])))

    merged = keyed.groupBy(doc, "type", "_key").agg(
        F.min_by("alias", "_at").alias("canonical"),
        F.min("_at").alias("_at"),
        *(F.expr(f"min_by(`{c}`, _at) filter (where `{c}` is not null)").alias(c) for c in scalars),
        *(united(c).alias(c) for c in lists),
        F.count(F.lit(1)).alias("n_merged"),
    )
    aliases = keyed.select(doc, "type", "_key", "alias").join(merged.select(doc, "type", "_key", "canonical"), [doc, "type", "_key"])
    return merged.select(doc, "type", "canonical", F.col("_at.chunk").alias("chunk"), F.col("_at.ord").alias("ord"), *scalars, *lists, "n_merged"), aliases.select(
        doc, "alias", "canonical"
    )


def merge_relationships(rels: DataFrame, aliases: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Ends renamed to canonical ids, rows with an unknown end dropped, the first of equal triples kept."""
    src = aliases.select(doc, F.col("alias").alias("source"), F.col("canonical").alias("_s"))
    tgt = aliases.select(doc, F.col("alias").alias("target"), F.col("canonical").alias("_t"))
    found = rels.join(src, [doc, "source"]).join(tgt, [doc, "target"]).select(doc, "chunk", "ord", F.col("_s").alias("source"), F.col("_t").alias("target"), "relationship_type")
    return first_of(found, [doc, "source", "target", "relationship_type"], "chunk", "ord")


def merge_asset_edges(edges: DataFrame, aliases: DataFrame, doc: str = "doc_id") -> DataFrame:
    src = aliases.select(doc, F.col("alias").alias("source"), F.col("canonical").alias("_s"))
    found = edges.join(src, [doc, "source"]).drop("source").withColumnRenamed("_s", "source").withColumn("_ref", text.normal("asset_reference"))
    return first_of(found, [doc, "source", "_ref"], "chunk", "ord").drop("_ref")


def merge_accounts(obs: DataFrame, aliases: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The first of equal (login in lower case, type); an unknown owner is cleared."""
    once = first_of(obs.withColumn("_login", F.lower("account_login")), [doc, "_login", "account_type"], "chunk", "ord").drop("_login")
    own = aliases.select(doc, F.col("alias").alias("identity_local_id"), F.col("canonical").alias("_o"))
    return once.join(own, [doc, "identity_local_id"], "left").withColumn("identity_local_id", F.coalesce("_o", F.lit(""))).drop("_o")


def merge_counters(raw: DataFrame, merged: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Rows before and after merging, per document."""
    a = raw.groupBy(doc).agg(F.count(F.lit(1)).alias("raw"))
    return a.join(merged.groupBy(doc).agg(F.count(F.lit(1)).alias("merged")), doc, "left").fillna(0, ["merged"])
