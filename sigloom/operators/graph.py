"""Node and edge tables from merged extractions, and the JSON bundles that leave the system."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import vocab
from ..functions import pattern as grammar
from ..functions import scalar, text
from . import state
from .relational import first_of, is_small, small

_NONE = "array<string>"
#: Groups of a taxonomy that are looked up within each row; more are joined.
FEW_GROUPS = 1000


def triples(spark, rows=vocab.TRIPLES) -> DataFrame:
    return spark.createDataFrame(list(rows), "source_type string, relationship_type string, target_type string")


def demoted(nodes: DataFrame) -> DataFrame:
    """Values that a type doesn't define, or its vocabulary hasn't, moved behind ``labels``.

    nodes: type, labels and any of the list and scalar properties below.
    """
    kind, have = F.col("type"), set(nodes.columns)
    none = F.array().cast(_NONE)
    lists = [
        ("malware_types", ("malware",), vocab.MALWARE_TYPES),
        ("tool_types", ("tool",), vocab.TOOL_TYPES),
        ("sectors", ("identity",), vocab.SECTORS),
        ("secondary_motivations", ("intrusion-set", "threat-actor"), vocab.MOTIVATIONS),
        ("aliases", ("vulnerability",), ("",)),
    ]
    scalars = [
        ("sophistication", ("intrusion-set",), ()),
        ("primary_motivation", ("intrusion-set", "threat-actor"), vocab.MOTIVATIONS),
        ("identity_class", ("identity",), vocab.IDENTITY_CLASSES),
    ]
    moved, changed = [], {}
    for name, types, words in scalars:
        if name in have:
            out = kind.isin(*types) & (~F.col(name).isin(*words) if words else F.col(name).isNotNull())
            moved.append(F.when(out, text.as_label(name)).otherwise(none))
            changed[name] = F.when(~F.coalesce(out, F.lit(False)), F.col(name))
    for name, types, words in lists:
        if name in have:
            moved.append(F.when(kind.isin(*types), text.outside(name, words)).otherwise(none))
            changed[name] = F.when(kind.isin(*types), text.inside(name, words)).otherwise(F.col(name))
    labels = F.coalesce(F.col("labels"), none)
    for more in moved:
        labels = F.array_union(labels, F.coalesce(more, none))
    return nodes.withColumns({**changed, "labels": F.when(F.size(labels) > 0, labels)})


def defaults(nodes: DataFrame, now: Column) -> DataFrame:
    """Required properties that a response left out, by type."""
    kind = F.col("type")
    given = lambda name, types, value: F.when(kind.isin(*types), F.coalesce(F.col(name), value)).otherwise(F.col(name))
    return nodes.withColumns(
        {
            "is_family": given("is_family", ("malware",), F.lit(False)),
            "valid_from": given("valid_from", ("indicator",), scalar.wire_time(now)),
            "pattern_type": given("pattern_type", ("indicator",), F.lit("stix")),
            "name": given("name", ("indicator",), text.indicator_name(F.coalesce("pattern", F.lit("")))),
            "description": given("description", ("indicator",), F.lit("Indicator extracted from a report")),
        }
    )


def valid_pattern(pattern: str | Column, pattern_type: str | Column) -> Column:
    """Whether an indicator's pattern is there, and is one by its grammar where its type is stix."""
    p = F.col(pattern) if isinstance(pattern, str) else pattern
    kind = F.col(pattern_type) if isinstance(pattern_type, str) else pattern_type
    stix = F.coalesce(kind, F.lit("stix")) == "stix"
    return F.coalesce((text.strip(p) != "") & (~stix | grammar.valid(F.when(stix, p))), F.lit(False))


def assemble_nodes(merged: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Nodes with ids, and the dropped rows with a reason (``invalid_pattern`` or ``no_cve``).

    merged: doc_id, canonical, type and the properties of ``extraction``.
    """
    cve = text.cve_id(F.col("name"), F.col("external_references"))
    reason = F.when((F.col("type") == "indicator") & ~valid_pattern("pattern", "pattern_type"), "invalid_pattern").when(
        (F.col("type") == "vulnerability") & cve.isNull(), "no_cve"
    )
    judged = merged.withColumns({"_cve": cve, "reason": reason})
    known = F.filter("external_references", lambda r: r["source_name"].isin("mitre-attack", "mitre-mobile-attack") & (text.strip(r["external_id"]) != ""))
    attack = F.get(F.transform(known, lambda r: r["external_id"]), F.lit(0))
    kept = judged.where("reason is null").withColumn("name", F.when(F.col("type") == "vulnerability", F.col("_cve")).otherwise(F.col("name")))
    # A node without a natural key gets an id that its document and place determine: retries agree.
    own = scalar.uuid5(vocab.NS_ENTITY, F.concat_ws("\0", F.col("doc_id").cast("string"), "canonical"))
    nodes = kept.withColumn("id", scalar.entity_id("type", F.coalesce("name", F.lit("")), attack, F.col("_cve"), own))
    return defaults(demoted(nodes.drop("_cve", "reason")), now), judged.where("reason is not null").select("doc_id", "canonical", "type", "reason")


def assemble_edges(rels: DataFrame, nodes: DataFrame, allowed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges between nodes, and dropped relationships with a reason (``unresolved`` or ``type_mismatch``)."""
    ends = nodes.select("doc_id", "canonical", "id", "type")
    s = ends.select("doc_id", F.col("canonical").alias("source"), F.col("id").alias("source_ref"), F.col("type").alias("source_type"))
    t = ends.select("doc_id", F.col("canonical").alias("target"), F.col("id").alias("target_ref"), F.col("type").alias("target_type"))
    joined = rels.join(s, ["doc_id", "source"], "left").join(t, ["doc_id", "target"], "left")
    ok = F.broadcast(allowed.withColumn("_ok", F.lit(True)))  # a constant table
    judged = joined.join(ok, ["source_type", "relationship_type", "target_type"], "left").withColumn(
        "reason",
        F.when(F.col("source_ref").isNull() | F.col("target_ref").isNull(), "unresolved").when(F.col("_ok").isNull(), "type_mismatch"),
    )
    return (
        judged.where("reason is null").select("doc_id", "chunk", "ord", "relationship_type", "source_ref", "target_ref"),
        judged.where("reason is not null").select("doc_id", "source", "target", "relationship_type", "reason"),
    )


def asset_links(edges: DataFrame, nodes: DataFrame, resolved: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Asset nodes (one per document and asset) and access edges from identities.

    edges: doc_id, source, asset_reference, description; resolved: reference, id, confidence; names: id, name.
    """
    ids = nodes.where(F.col("type") == "identity").select("doc_id", F.col("canonical").alias("source"), F.col("id").alias("source_ref"))
    r = resolved.select(F.col("reference").alias("asset_reference"), F.col("id").alias("asset_id"), "confidence")
    linked = edges.join(ids, ["doc_id", "source"]).join(r, "asset_reference")
    target = F.concat(F.lit(f"{vocab.ASSET_NODE}--"), scalar.uuid5(vocab.NS_ASSET, "asset_id"))
    links = linked.withColumn("target_ref", target)
    made = links.select("doc_id", "asset_id", F.col("target_ref").alias("id")).distinct()
    made = made.join(names.select(F.col("id").alias("asset_id"), "name"), "asset_id", "left").withColumn("type", F.lit(vocab.ASSET_NODE))
    return made, links.select("doc_id", F.lit(vocab.HAS_ACCESS).alias("relationship_type"), "source_ref", "target_ref", "confidence", "description")


def account_links(obs: DataFrame, nodes: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Account and observation nodes; owner edges (related-to) and edges to resolved assets."""
    key = F.concat("account_login", F.lit("\0"), "account_type")
    own = obs.withColumn("id", F.concat(F.lit("user-account--"), scalar.uuid5(vocab.NS_ACCOUNT, key)))
    account = own.select("doc_id", "id", F.lit("user-account").alias("type"), "account_login", "display_name", "account_type", "is_privileged", "is_service_account")
    wrapper = own.select(
        "doc_id",
        F.concat(F.lit("observed-data--"), scalar.uuid5(vocab.NS_ACCOUNT, F.concat(F.col("doc_id").cast("string"), F.lit("\0"), "id"))).alias("id"),
        F.lit("observed-data").alias("type"),
        F.array("id").alias("object_refs"),
    )
    ids = nodes.where(F.col("type") == "identity").select("doc_id", F.col("canonical").alias("identity_local_id"), F.col("id").alias("target_ref"))
    owner = own.join(ids, ["doc_id", "identity_local_id"]).select(
        "doc_id", F.lit("related-to").alias("relationship_type"), F.col("id").alias("source_ref"), "target_ref", F.lit(None).cast("int").alias("confidence")
    )
    r = resolved.select("reference", F.col("id").alias("asset_id"), "confidence")
    on = own.select("doc_id", "id", F.explode("asset_references").alias("reference")).join(r, "reference")
    on = on.select(
        "doc_id",
        F.lit(vocab.VALID_ON).alias("relationship_type"),
        F.col("id").alias("source_ref"),
        F.concat(F.lit(f"{vocab.ASSET_NODE}--"), scalar.uuid5(vocab.NS_ASSET, "asset_id")).alias("target_ref"),
        "confidence",
    )
    return account.unionByName(wrapper, allowMissingColumns=True), owner.unionByName(on)


def identity_links(edges: DataFrame, nodes: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Internal identity nodes, named by the first reference to each, and the edges to them."""
    ids = nodes.select("doc_id", F.col("canonical").alias("source"), F.col("id").alias("source_ref"))
    r = resolved.select(F.col("reference").alias("target_identity_reference"), F.col("id").alias("identity_id"))
    linked = edges.join(ids, ["doc_id", "source"]).join(r, "target_identity_reference")
    linked = linked.withColumn("target_ref", F.concat(F.lit(f"{vocab.IDENTITY_NODE}--"), scalar.uuid5(vocab.NS_IDENTITY, "identity_id")))
    made = first_of(linked, ["doc_id", "identity_id"], "chunk", "ord").select(
        "doc_id", F.col("target_ref").alias("id"), F.lit(vocab.IDENTITY_NODE).alias("type"), "identity_id", F.col("target_identity_reference").alias("name")
    )
    return made, linked.select("doc_id", "relationship_type", "source_ref", "target_ref", "confidence", "description")


def extension(stamp: Column) -> Column:
    """The definition that declares the engine's own properties, as a JSON text."""
    fixed = {"type": "extension-definition", "id": vocab.EXTENSION_ID, "spec_version": "2.1"}
    more = {"name": "bundle metadata", "description": vocab.EXTENSION_TEXT, "schema": vocab.EXTENSION_SCHEMA, "version": vocab.EXTENSION_VERSION}
    lists = {"extension_types": ("toplevel-property-extension", "new-sdo"), "extension_properties": vocab.EXTENSION_PROPERTIES}
    return F.to_json(
        F.struct(
            *(F.lit(v).alias(k) for k, v in fixed.items()),
            stamp.alias("created"),
            stamp.alias("modified"),
            *(F.lit(v).alias(k) for k, v in more.items()),
            *(F.array(*map(F.lit, v)).alias(k) for k, v in lists.items()),
        )
    )


META = ("source_url", "collected_at", "matched_pir_ids", "relevance_score", "relevance_rationale")


def bundles(nodes: DataFrame, edges: DataFrame, now: Column, meta: DataFrame | None = None) -> DataFrame:
    """(doc_id, bundle) with one JSON document each; nulls and empty lists are left out.

    A bundle holds what one document gave, so that its group is bounded by the document. ``meta``
    (doc_id and any of META) becomes properties of the envelope. A bundle with such properties, or
    with nodes of the engine's own types or accounts, begins with their definition.
    """
    stamp = scalar.wire_time(now)
    wire = {"spec_version": F.lit("2.1"), "created": stamp, "modified": stamp}
    as_json = lambda df, drop: F.to_json(F.struct(*(F.col(c) for c in df.columns if c not in drop)))
    own = F.col("type").isin(vocab.ASSET_NODE, vocab.IDENTITY_NODE, "user-account")
    n = nodes.withColumns(wire)
    n = n.select(
        "doc_id", F.lit(0).alias("part"), F.col("id").alias("key"), own.alias("own"), as_json(n, {"doc_id", "canonical", "chunk", "ord", "n_merged"}).alias("o")
    )
    rid = F.concat(F.lit("relationship--"), scalar.uuid5(vocab.NS_ENTITY, F.concat_ws("\0", F.col("doc_id").cast("string"), "source_ref", "relationship_type", "target_ref")))
    e = edges.withColumns({"type": F.lit("relationship"), "id": rid, **wire})
    e = e.select("doc_id", F.lit(1).alias("part"), F.col("id").alias("key"), F.lit(False).alias("own"), as_json(e, {"doc_id", "chunk", "ord"}).alias("o"))
    grouped = n.unionByName(e).dropDuplicates(["doc_id", "key"]).groupBy("doc_id")
    grouped = grouped.agg(F.array_sort(F.collect_list(F.struct("part", "key", "o"))).alias("os"), F.bool_or("own").alias("extended"))
    envelope = F.concat(
        F.lit('{"type":"bundle","id":"bundle--'),
        scalar.uuid5(vocab.NS_ENTITY, F.concat(F.lit("bundle\0"), F.col("doc_id").cast("string"))),
        F.lit('"'),
    )
    extended = F.coalesce("extended", F.lit(False))
    if meta is not None:
        given = [c for c in META if c in meta.columns]
        grouped = grouped.join(meta.select("doc_id", *given), "doc_id", "left")
        value = {c: F.col(c) for c in given}
        if "relevance_rationale" in value:
            value["relevance_rationale"] = F.nullif("relevance_rationale", F.lit(""))
        if "source_url" in value:
            value["collected_at"] = F.when(F.col("source_url").isNotNull(), F.coalesce(value.get("collected_at", F.lit(None).cast("string")), stamp))
        extra = F.to_json(F.struct(*(v.alias(f"{vocab.PROPERTY}{c}") for c, v in value.items())))
        extended = extended | (F.length(extra) > 2)
        envelope = F.concat(envelope, F.when(F.length(extra) > 2, F.concat(F.lit(","), F.substring(extra, F.lit(2), F.length(extra) - 2))).otherwise(""))
    declared = f',"extensions":{{"{vocab.EXTENSION_ID}":{{"extension_type":"toplevel-property-extension"}}}}'
    envelope = F.concat(envelope, F.when(extended, declared).otherwise(""))
    listed = F.transform("os", lambda o: o["o"])
    body = F.array_join(F.when(extended, F.concat(F.array(extension(stamp)), listed)).otherwise(listed), ",")
    return grouped.select("doc_id", F.concat(envelope, F.lit(',"objects":['), body, F.lit("]}")).alias("bundle"))


def hashed_references(nodes: DataFrame, cache: DataFrame, fetched: DataFrame | None, now: Column, ttl_days: int = 30) -> tuple[DataFrame, DataFrame]:
    """Nodes whose external references with a URL carry its content's hash, and the cache after that.

    See ``state.with_hashes``. References keep their order; those without a URL stay as they are.
    """
    flat = nodes.select("doc_id", "canonical", F.posexplode("external_references").alias("pos", "r"))
    refs, after = state.with_hashes(flat.withColumn("url", F.nullif("r.url", F.lit(""))), cache, fetched, now, ttl_days)
    hashes = F.when(F.col("sha256").isNotNull(), F.create_map(F.lit("SHA-256"), F.col("sha256")))
    one = F.struct("pos", F.struct("r.source_name", "r.external_id", "r.url", hashes.alias("hashes")).alias("r"))
    listed = refs.groupBy("doc_id", "canonical").agg(F.collect_list(one).alias("rs"))
    order = F.array_sort("rs", lambda a, b: a["pos"] - b["pos"])
    listed = listed.select("doc_id", "canonical", F.transform(order, lambda r: r["r"]).alias("_refs"))
    joined = nodes.join(listed, ["doc_id", "canonical"], "left")
    return joined.withColumn("external_references", F.col("_refs")).drop("_refs"), after


# --- taxonomy ---------------------------------------------------------------------------------


def taxonomy_rows(spark, tree: dict) -> DataFrame:
    """(group_norm, tag, ord) of every node that has tags and groups, in reading order.

    The tree is one configuration document, walked on the driver.
    """
    rows: list[tuple[str, str, int]] = []

    def walk(node) -> None:
        if isinstance(node, dict):
            for group in node.get("mitre_groups") or []:
                for tag in node.get("tags") or []:
                    if isinstance(group, str) and isinstance(tag, str):
                        rows.append((" ".join(group.split()).lower(), tag, len(rows)))
            for child in node.values():
                walk(child)
        elif isinstance(node, list):
            for child in node:
                walk(child)

    walk({k: v for k, v in tree.items() if not k.startswith("_")})
    return spark.createDataFrame(rows, "group_norm string, tag string, ord int")


def taxonomy_tags(tree) -> set[str]:
    """Every tag of the tree."""
    if isinstance(tree, dict):
        own = {t for t in tree.get("tags") or [] if isinstance(t, str)} if isinstance(tree.get("tags"), list) else set()
        return own.union(*(taxonomy_tags(v) for v in tree.values()))
    return set().union(*(taxonomy_tags(v) for v in tree)) if isinstance(tree, list) else set()


def index_tags(rows: DataFrame) -> DataFrame:
    """(group_norm, tags): distinct, in order of appearance."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "tag")))
    return rows.groupBy("group_norm").agg(F.array_distinct(F.transform(ordered, lambda r: r["tag"])).alias("tags"))


def enrich(actors: DataFrame, index: DataFrame, key: str = "id") -> DataFrame:
    """Tags of the groups that an actor's name or aliases name, behind its labels; ``n_added`` counts the new ones."""
    none = F.array().cast(_NONE)
    names = F.concat(F.array("name"), F.coalesce("aliases", none))
    named = actors.select(key, F.posexplode(names).alias("pos", "n")).withColumn("group_norm", text.normal_name("n"))
    found = named.join(small(index), "group_norm").groupBy(key).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "tags"))), lambda r: r["tags"])).alias("_tags")
    )
    joined = actors.join(found, key, "left").withColumn("_before", F.coalesce("labels", none))
    labels = F.array_union("_before", F.coalesce("_tags", none))
    return joined.withColumns({"labels": F.when(F.size(labels) > 0, labels), "n_added": F.size(labels) - F.size(F.array_distinct("_before"))}).drop("_tags", "_before")


@F.pandas_udf(T.StringType())
def _labelled(objects: pd.Series, labels: pd.Series) -> pd.Series:
    return pd.Series([json.dumps({**json.loads(o), "labels": list(tags)}, ensure_ascii=False) for o, tags in zip(objects, labels)], dtype=object)


def _rebuilt(objects: Column) -> Column:
    """The JSON text of a bundle ``v`` with other objects, which are JSON texts."""
    keys = F.map_from_entries(F.filter(F.map_entries(F.from_json(F.to_json("v"), "map<string,variant>")), lambda e: e["key"] != "objects"))
    rest = F.to_json(keys)
    return F.concat(
        F.when(F.length(rest) > 2, F.concat(F.substring(rest, F.lit(1), F.length(rest) - 1), F.lit(","))).otherwise("{"), F.lit('"objects":['), F.array_join(objects, ","), F.lit("]}")
    )


def _enriched_rows(texts: DataFrame, tags: dict[str, list[str]], path: str, value: str) -> DataFrame:
    """:func:`enriched_bundles` by few groups, each text within its row."""
    table = F.from_json(F.lit(json.dumps(tags)), f"map<string,{_NONE}>")
    none = F.array().cast(_NONE)
    get = lambda o, name, kind="string": F.try_variant_get(o, f"$.{name}", kind)
    named = lambda o: F.concat(F.array(get(o, "name")), F.coalesce(get(o, "aliases", _NONE), none))
    found = lambda o: F.flatten(F.transform(named(o), lambda n: F.coalesce(F.try_element_at(table, text.normal_name(n)), none)))
    acts = lambda o: F.coalesce(get(o, "type").isin("threat-actor", "intrusion-set") & get(o, "name").isNotNull(), F.lit(False))
    parsed = texts.select(F.col(path).alias("path"), F.col(value).alias("value"), F.try_parse_json(value).alias("v"))
    listed = parsed.withColumn("os", F.transform(get("v", "objects", "array<variant>"), lambda o: F.struct(o.alias("o"), F.coalesce(get(o, "labels", _NONE), none).alias("l"), F.when(acts(o), found(o)).alias("t"))))
    more = lambda o: F.size(F.array_except(o["t"], o["l"])) > 0
    counted = listed.withColumn("n", F.coalesce(F.size(F.filter("os", more)), F.lit(0)))

    def labelled(o: Column) -> Column:
        labels = F.parse_json(F.to_json(F.array_union(o["l"], o["t"])))
        own = F.map_filter(F.from_json(F.to_json(o["o"]), "map<string,variant>"), lambda k, _: k != "labels")
        return F.to_json(F.map_concat(own, F.create_map(F.lit("labels"), labels)))

    objects = F.transform("os", lambda o: F.when(more(o), labelled(o)).otherwise(F.to_json(o["o"])))
    n = F.greatest(F.col("n"), F.lit(0))  # -1 is the size of no list in old sessions
    return counted.select("path", F.when(n > 0, _rebuilt(objects)).otherwise(F.col("value")).alias("value"), n.cast("bigint").alias("n_enriched"))


def enriched_bundles(texts: DataFrame, index: DataFrame, path: str = "path", value: str = "value") -> DataFrame:
    """(path, value, n_enriched): bundles whose actors carry the tags of the groups that they name.

    Only objects that gain a tag are rewritten; the others, and their order, stay. A text that isn't
    a bundle comes back as it is. Few groups are looked up within each row, without a shuffle.
    """
    groups = index.where("group_norm is not null")
    if is_small(groups, FEW_GROUPS):
        return _enriched_rows(texts, {r["group_norm"]: r["tags"] for r in groups.collect()}, path, value)
    parsed = texts.select(F.col(path).alias("path"), F.col(value).alias("value"), F.try_parse_json(value).alias("v"))
    objects = parsed.select("path", F.posexplode(F.try_variant_get("v", "$.objects", "array<variant>")).alias("pos", "o"))
    many = "array<string>"
    objects = objects.select(
        "path",
        "pos",
        F.to_json("o").alias("json"),
        F.try_variant_get("o", "$.type", "string").alias("type"),
        F.try_variant_get("o", "$.name", "string").alias("name"),
        F.try_variant_get("o", "$.aliases", many).alias("aliases"),
        F.try_variant_get("o", "$.labels", many).alias("labels"),
    )
    objects = objects.withColumn("key", F.struct("path", "pos"))
    actors = objects.where(F.col("type").isin("threat-actor", "intrusion-set") & F.col("name").isNotNull())
    gained = enrich(actors, index, "key").where("n_added > 0")
    changed = gained.select("path", "pos", _labelled("json", "labels").alias("json"), F.lit(1).alias("n"))
    kept = objects.select("path", "pos", "json", F.lit(0).alias("n")).join(changed.select("path", "pos"), ["path", "pos"], "left_anti")
    listed = kept.unionByName(changed).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("pos", "json"))).alias("os"), F.sum("n").alias("n"))
    rebuilt = _rebuilt(F.transform("os", lambda o: o["json"]))
    return parsed.join(listed, "path", "left").select(
        "path", F.when(F.col("n") > 0, rebuilt).otherwise(F.col("value")).alias("value"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_enriched")
    )
