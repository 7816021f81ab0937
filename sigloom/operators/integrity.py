"""Validation: every rule gives rows of ``findings`` (severity, code, location, message)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text
from .relational import counted_duplicates, small

FINDING = "severity string, code string, location string, message string"


def finding(severity: str | Column, code: str, location: Column, message: Column) -> list[Column]:
    s = F.lit(severity) if isinstance(severity, str) else severity
    return [s.alias("severity"), F.lit(code).alias("code"), location.alias("location"), message.alias("message")]


def union(findings: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def duplicates(df: DataFrame, keys: list[str], code: str, location: str, severity: str = "error") -> DataFrame:
    """One finding per key that occurs twice or more."""
    named = F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))
    return counted_duplicates(df, keys).select(*finding(severity, code, F.lit(location), F.concat(F.lit("occurs "), F.col("n").cast("string"), F.lit(" times: "), named)))


def dangling(refs: DataFrame, ref: str, targets: DataFrame, target: str, code: str, location: Column, severity: str = "error") -> DataFrame:
    """One finding per row whose reference isn't among the targets; null references are no references.

    Left anti join on the reference: partitioned by it, or by a broadcast of the ids where these are few.
    """
    ids = targets.select(F.col(target).alias("_id")).distinct()
    lost = refs.where(F.col(ref).isNotNull()).join(ids, F.col(ref) == F.col("_id"), "left_anti")
    return lost.select(*finding(severity, code, location, F.concat(F.lit(f"{ref} "), F.col(ref).cast("string"), F.lit(" does not resolve"))))


def at(name: str, pos: str = "pos", more: str = "") -> Column:
    return F.concat(F.lit(f"{name}["), F.col(pos).cast("string"), F.lit(f"]{more}"))


def check_rules(df: DataFrame, rules: list[tuple[str, str, Column]], location: Column, severity: str = "error") -> DataFrame:
    """Field rules as data: (code, field, predicate that holds for a violation); one pass for all rules."""
    hits = F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(field).alias("field"))) for code, field, bad in rules))
    found = df.select(location.alias("_at"), F.inline(F.filter(hits, lambda h: h.isNotNull())))
    return found.select(
        F.lit(severity).alias("severity"),
        "code",
        F.concat_ws(".", "_at", "field").alias("location"),
        F.concat(F.lit("value of "), "field", F.lit(" is not allowed")).alias("message"),
    )


def blank(name: str) -> Column:
    return F.col(name).isNull() | (text.strip(name) == "")


def beyond(name: str, low: float, high: float) -> Column:
    return F.col(name).isNull() | ~F.col(name).between(low, high)


def not_in(name: str, words) -> Column:
    return ~F.col(name).isin(*words)


# --- inventories ------------------------------------------------------------------------------


def check_assets(t: dict[str, DataFrame]) -> DataFrame:
    """References and unique ids of an inventory.

    Tables, each with ``pos``: assets, network_segments, security_controls, asset_vulnerabilities,
    asset_connections, actor_targets.
    """
    assets = t["assets"]
    controls = assets.select(F.col("pos"), F.posexplode("security_control_ids").alias("j", "control_id"))
    nested = F.concat(at("assets"), F.lit(".security_control_ids["), F.col("j").cast("string"), F.lit("]"))
    out = [
        dangling(assets, "network_segment_id", t["network_segments"], "id", "ASSET_REF_SEGMENT", at("assets")),
        dangling(controls, "control_id", t["security_controls"], "id", "ASSET_REF_CONTROL", nested),
        dangling(t["asset_vulnerabilities"], "asset_id", assets, "id", "VULN_REF_ASSET", at("asset_vulnerabilities")),
        dangling(t["actor_targets"], "asset_id", assets, "id", "ACTOR_TARGET_REF_ASSET", at("actor_targets")),
    ]
    ends = t["asset_connections"].select("pos", F.expr("stack(2, 'src', src, 'dst', dst) as (side, asset)"))
    out.append(dangling(ends, "asset", assets, "id", "CONNECTION_REF_ASSET", F.concat(at("asset_connections", more="."), F.col("side"))))
    out += [duplicates(t[k], ["id"], "ID_NOT_UNIQUE", k) for k in ("network_segments", "security_controls", "assets")]
    return union(out)


def asset_fields(t: dict[str, DataFrame]) -> DataFrame:
    a = t["assets"]
    return union(
        [
            check_rules(
                a,
                [("ASSETS_SCHEMA", f, blank(f)) for f in ("id", "name")] + [("ASSETS_SCHEMA", "criticality", beyond("criticality", 0, 10))],
                at("assets"),
            ),
            check_rules(t["asset_connections"], [("ASSETS_SCHEMA", "port", F.col("port").isNotNull() & ~F.col("port").between(0, 65535))], at("asset_connections")),
            check_rules(t["actor_targets"], [("ASSETS_SCHEMA", "confidence", beyond("confidence", 0, 100))], at("actor_targets")),
        ]
    )


def check_identities(t: dict[str, DataFrame], assets: DataFrame) -> DataFrame:
    access = t["has_access"]
    return union(
        [
            dangling(access, "identity_id", t["identities"], "id", "HAS_ACCESS_REF_IDENTITY", at("has_access")),
            dangling(access, "asset_id", assets, "id", "HAS_ACCESS_REF_ASSET", at("has_access")),
            duplicates(t["identities"], ["id"], "IDENTITY_ID_NOT_UNIQUE", "identities"),
            duplicates(access, ["identity_id", "asset_id"], "HAS_ACCESS_DUPLICATE_PAIR", "has_access", "warning"),
        ]
    )


def identity_fields(t: dict[str, DataFrame]) -> DataFrame:
    late = (F.col("granted_at") != "") & (F.col("revoked_at") != "") & (F.col("granted_at") >= F.col("revoked_at"))
    return union(
        [
            check_rules(
                t["identities"],
                [("IDENTITY_ASSETS_SCHEMA", f, blank(f)) for f in ("id", "name")] + [("IDENTITY_ASSETS_SCHEMA", "identity_class", not_in("identity_class", vocab.IDENTITY_CLASSES))],
                at("identities"),
            ),
            check_rules(
                t["has_access"],
                [("IDENTITY_ASSETS_SCHEMA", "access_level", not_in("access_level", vocab.ACCESS_LEVELS)), ("IDENTITY_ASSETS_SCHEMA", "granted_at", late)],
                at("has_access"),
            ),
        ]
    )


def check_accounts(t: dict[str, DataFrame], assets: DataFrame, identities: DataFrame | None = None) -> DataFrame:
    accounts, on = t["user_accounts"], t["account_on_asset"]
    out = [
        dangling(on, "user_account_id", accounts, "id", "ACCOUNT_ON_ASSET_REF_USER_ACCOUNT", at("account_on_asset")),
        dangling(on, "asset_id", assets, "id", "ACCOUNT_ON_ASSET_REF_ASSET", at("account_on_asset")),
        duplicates(accounts, ["id"], "USER_ACCOUNT_ID_NOT_UNIQUE", "user_accounts"),
        duplicates(on, ["user_account_id", "asset_id"], "ACCOUNT_ON_ASSET_DUPLICATE_PAIR", "account_on_asset", "warning"),
    ]
    if identities is not None:
        owned = accounts.where("identity_id <> ''")
        out.insert(0, dangling(owned, "identity_id", identities, "id", "USER_ACCOUNT_REF_IDENTITY", at("user_accounts")))
    return union(out)


def account_fields(t: dict[str, DataFrame]) -> DataFrame:
    late = (F.col("first_seen") != "") & (F.col("last_seen") != "") & (F.col("first_seen") >= F.col("last_seen"))
    return union(
        [
            check_rules(
                t["user_accounts"],
                [("USER_ACCOUNTS_SCHEMA", f, blank(f)) for f in ("id", "account_login")] + [("USER_ACCOUNTS_SCHEMA", "account_type", not_in("account_type", (*vocab.ACCOUNT_TYPES, "")))],
                at("user_accounts"),
            ),
            check_rules(t["account_on_asset"], [("USER_ACCOUNTS_SCHEMA", "first_seen", late)], at("account_on_asset")),
        ]
    )


def check_pirs(pirs: DataFrame, tags: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Tags unknown to the taxonomy (warning), rule tags that no asset has (if assets are given), repeated ids."""
    j = lambda field: F.concat(at("pir"), F.lit(f".{field}["), F.col("j").cast("string"), F.lit("]"))
    actor = pirs.select("pos", F.posexplode("threat_actor_tags").alias("j", "tag"))
    out = [
        dangling(actor, "tag", tags, "tag", "PIR_TAG_NOT_IN_TAXONOMY", j("threat_actor_tags"), "warning"),
        duplicates(pirs, ["pir_id"], "PIR_ID_NOT_UNIQUE", "pir[*].pir_id"),
    ]
    if assets is not None:
        rules = pirs.select("pos", F.posexplode("asset_weight_rules").alias("j", "rule")).withColumn("tag", F.col("rule.tag"))
        used = assets.select(F.explode("tags").alias("tag"))
        out.append(dangling(rules, "tag", used, "tag", "PIR_RULE_TAG_UNUSED", j("asset_weight_rules")))
    return union(out)


def pir_fields(pirs: DataFrame) -> DataFrame:
    return check_rules(
        pirs,
        [("PIR_SCHEMA", "pir_id", blank("pir_id")), ("PIR_SCHEMA", "valid_until", F.col("valid_from") >= F.col("valid_until"))],
        at("pir"),
    )


def version_findings(versions: DataFrame, column: str = "schema_version") -> DataFrame:
    """Only the current version passes; older ones and unknown ones get a message of their own."""
    v = F.col(column)
    why = (
        F.when(v.isNull(), "schema_version is missing")
        .when(v.isin(*vocab.OLD_SCHEMA_VERSIONS), F.concat(F.lit("schema_version "), v, F.lit(f" is no longer read; produce {vocab.SCHEMA_VERSION}")))
        .otherwise(F.concat(F.lit("schema_version "), v, F.lit(" is not known")))
    )
    return versions.where(v.isNull() | (v != vocab.SCHEMA_VERSION)).select(*finding("error", "PIR_SCHEMA", F.lit(column), why))


# --- bundles ----------------------------------------------------------------------------------


def check_refs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Both ends of an edge must be there and be nodes of the same bundle."""
    ends = edges.select("bundle_id", "pos", F.expr("stack(2, 'source_ref', source_ref, 'target_ref', target_ref) as (field, ref)"))
    where = F.concat(at("objects", more="."), F.col("field"))
    missing = ends.where("ref is null or ref = ''").select(*finding("error", "REL_REF_MISSING", where, F.concat("field", F.lit(" is missing"))))
    ids = nodes.select("bundle_id", F.col("id").alias("ref")).distinct()
    lost = ends.where("ref <> ''").join(ids, ["bundle_id", "ref"], "left_anti")
    return missing.unionByName(lost.select(*finding("error", "REL_REF_UNRESOLVED", where, F.concat("field", F.lit(" "), "ref", F.lit(" is not in the bundle")))))


def check_attribution(nodes: DataFrame, edges: DataFrame, allowed: DataFrame) -> DataFrame:
    """Attribution and impersonation edges against their matrix; an unknown end's type is its id's prefix."""
    n = nodes.groupBy("bundle_id", "id").agg(F.min("type").alias("type"))  # an id that occurs twice is another rule's finding
    side = lambda ref, name: n.select("bundle_id", F.col("id").alias(ref), F.col("type").alias(name))
    typed = (
        edges.where(F.col("relationship_type").isin("attributed-to", "impersonates"))
        .join(side("source_ref", "_s"), ["bundle_id", "source_ref"], "left")
        .join(side("target_ref", "_t"), ["bundle_id", "target_ref"], "left")
        .withColumns(
            {
                "source_type": F.coalesce("_s", F.split_part("source_ref", F.lit("--"), F.lit(1))),
                "target_type": F.coalesce("_t", F.split_part("target_ref", F.lit("--"), F.lit(1))),
            }
        )
    )
    bad = typed.join(F.broadcast(allowed), ["source_type", "relationship_type", "target_type"], "left_anti")  # a constant table
    what = F.concat_ws(" ", "source_type", "relationship_type", "target_type")
    return bad.select(*finding("error", "RELATIONSHIP_TYPE_MATCH", F.concat(F.lit("relationship id="), F.coalesce("id", F.lit("?"))), F.concat(what, F.lit(" is not allowed"))))


def check_identity_refs(nodes: DataFrame, known: DataFrame) -> DataFrame:
    internal = nodes.where(F.col("type") == vocab.IDENTITY_NODE)
    where = F.concat(F.lit(f"{vocab.IDENTITY_NODE} id="), F.col("id"))
    return dangling(internal, "identity_id", known, "id", "IDENTITY_REF_RESOLUTION", where, "warning")


def check_kill_chains(nodes: DataFrame, name: str = "mitre-attack") -> DataFrame:
    phases = nodes.select("pos", F.posexplode("kill_chain_phases").alias("j", "phase"))
    bad = phases.where(~F.col("phase.kill_chain_name").eqNullSafe(F.lit(name)))
    where = F.concat(at("objects"), F.lit(".kill_chain_phases["), F.col("j").cast("string"), F.lit("].kill_chain_name"))
    return bad.select(*finding("error", "KILL_CHAIN_NAME", where, F.concat(F.lit("expected "), F.lit(name))))


def check_bundle(heads: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The local rules: type of the envelope, unique ids, references, kill chains."""
    wrong = heads.where(~F.col("type").eqNullSafe(F.lit("bundle")))
    everything = nodes.select("bundle_id", "id").unionByName(edges.select("bundle_id", "id"))
    twice = counted_duplicates(everything, ["bundle_id", "id"])
    return union(
        [
            wrong.select(*finding("error", "BUNDLE_TYPE", F.lit("bundle.type"), F.lit("not a bundle"))),
            twice.select(*finding("error", "STIX_ID_NOT_UNIQUE", F.concat(F.lit("objects[*].id="), F.col("id")), F.lit("id occurs twice or more"))),
            check_refs(nodes, edges),
            check_kill_chains(nodes),
        ]
    )


def check_texts(raw: DataFrame, allowed: list[tuple[str, str, str]], known: DataFrame | None = None, value: str = "value") -> DataFrame:
    """:func:`check_bundle`, :func:`check_attribution` and, with ``known``, :func:`check_identity_refs` of bundles from their JSON texts, each within its row.

    A text is parsed once and nothing is shuffled: ends meet nodes within the bundle. Work may be
    quadratic in the objects of one bundle, so very long texts are left to the joins.
    """
    get = lambda o, name, kind="string": F.try_variant_get(o, f"$.{name}", kind)
    phases = lambda o: F.from_json(F.to_json(get(o, "kill_chain_phases", "variant")), "array<struct<kill_chain_name:string,phase_name:string>>")
    names = ("id", "type", "identity_id", "relationship_type", "source_ref", "target_ref")
    one = lambda o, i: F.struct(i.cast("string").alias("pos"), *(get(o, n).alias(n) for n in names), phases(o).alias("phases"))
    parsed = raw.select(F.try_parse_json(value).alias("v")).select(get("v", "type").alias("type"), F.transform(get("v", "objects", "array<variant>"), one).alias("os"))
    split = parsed.select(
        "type",
        F.filter("os", lambda o: o["type"] != "relationship").alias("nodes"),
        F.filter("os", lambda o: o["type"] == "relationship").alias("edges"),
        F.array_sort(F.transform(F.filter("os", lambda o: o["type"].isNotNull()), lambda o: o["id"])).alias("ids"),
    )
    ends = lambda o: F.array(*(F.struct(F.concat(F.lit("objects["), o["pos"], F.lit(f"].{f}")).alias("at"), F.lit(f).alias("field"), o[f].alias("ref")) for f in ("source_ref", "target_ref")))
    typed = lambda nodes, ref: F.coalesce(F.array_min(F.transform(F.filter(nodes, lambda n: n["id"] == ref), lambda n: n["type"])), F.split_part(ref, F.lit("--"), F.lit(1)))
    ready = split.select(
        "type",
        "nodes",
        "ids",
        F.flatten(F.transform("edges", ends)).alias("ends"),
        F.transform(
            F.filter("edges", lambda e: e["relationship_type"].isin("attributed-to", "impersonates")),
            lambda e: F.struct(e["id"].alias("id"), typed(F.col("nodes"), e["source_ref"]).alias("s"), e["relationship_type"].alias("r"), typed(F.col("nodes"), e["target_ref"]).alias("t")),
        ).alias("told"),
    )
    ready = ready.withColumn("lost", F.array_except(F.filter(F.transform("ends", lambda e: e["ref"]), lambda r: r != ""), F.transform("nodes", lambda n: n["id"])))
    none = F.lit(None).cast("string")
    hit = lambda severity, code, location, message, ref=none: F.struct(
        F.lit(severity).alias("severity"), F.lit(code).alias("code"), location.alias("location"), message.alias("message"), ref.alias("_ref")
    )
    before = lambda i, k: F.get("ids", i - k)
    twice = F.filter("ids", lambda x, i: (i > 0) & x.eqNullSafe(before(i, 1)) & ((i < 2) | ~x.eqNullSafe(before(i, 2))))
    fits = lambda e: F.coalesce(reduce(lambda a, b: a | b, ((e["s"] == s) & (e["r"] == r) & (e["t"] == t) for s, r, t in allowed)), F.lit(False))
    chained = F.flatten(
        F.transform(
            "nodes",
            lambda n: F.coalesce(
                F.filter(
                    F.transform(n["phases"], lambda p, j: F.when(~p["kill_chain_name"].eqNullSafe(F.lit("mitre-attack")), F.concat(F.lit("objects["), n["pos"], F.lit("].kill_chain_phases["), j.cast("string"), F.lit("].kill_chain_name")))),
                    lambda x: x.isNotNull(),
                ),
                F.array().cast("array<string>"),
            ),
        )
    )
    hits = [
        F.when(~F.col("type").eqNullSafe(F.lit("bundle")), F.array(hit("error", "BUNDLE_TYPE", F.lit("bundle.type"), F.lit("not a bundle")))),
        F.transform(twice, lambda x: hit("error", "STIX_ID_NOT_UNIQUE", F.concat(F.lit("objects[*].id="), x), F.lit("id occurs twice or more"))),
        F.transform(F.filter("ends", lambda e: e["ref"].isNull() | (e["ref"] == "")), lambda e: hit("error", "REL_REF_MISSING", e["at"], F.concat(e["field"], F.lit(" is missing")))),
        F.transform(F.filter("ends", lambda e: F.array_contains("lost", e["ref"])), lambda e: hit("error", "REL_REF_UNRESOLVED", e["at"], F.concat(e["field"], F.lit(" "), e["ref"], F.lit(" is not in the bundle")))),
        F.transform(chained, lambda at_: hit("error", "KILL_CHAIN_NAME", at_, F.lit("expected mitre-attack"))),
        F.transform(
            F.filter("told", lambda e: ~fits(e)),
            lambda e: hit("error", "RELATIONSHIP_TYPE_MATCH", F.concat(F.lit("relationship id="), F.coalesce(e["id"], F.lit("?"))), F.concat(F.concat_ws(" ", e["s"], e["r"], e["t"]), F.lit(" is not allowed"))),
        ),
    ]
    if known is not None:
        internal = F.filter("nodes", lambda n: (n["type"] == vocab.IDENTITY_NODE) & n["identity_id"].isNotNull())
        lost = lambda n: F.concat(F.lit("identity_id "), n["identity_id"], F.lit(" does not resolve"))
        hits.append(F.transform(internal, lambda n: hit("warning", "IDENTITY_REF_RESOLUTION", F.concat(F.lit(f"{vocab.IDENTITY_NODE} id="), n["id"]), lost(n), n["identity_id"])))
    every = F.concat(*(F.coalesce(h, F.array().cast("array<struct<severity:string,code:string,location:string,message:string,_ref:string>>")) for h in hits))
    # An outer one: for a plain one Spark infers a filter that computes all of this twice.
    found = ready.select(F.inline_outer(every)).where("code is not null")
    if known is not None:
        # Findings that wait for no identity have keys of their own, so that they neither match nor meet.
        key = F.struct(F.col("_ref").isNull().alias("own"), F.coalesce("_ref", "location").alias("id"))
        ids = known.where("id is not null").select(F.struct(F.lit(False).alias("own"), F.col("id").cast("string").alias("id")).alias("_key")).distinct()
        found = found.withColumn("_key", key).join(small(ids), "_key", "left_anti")
    return found.select("severity", "code", "location", "message")


def strict(findings: DataFrame) -> DataFrame:
    """Warnings promoted to errors."""
    return findings.withColumn("severity", F.when(F.col("severity") == "warning", "error").otherwise(F.col("severity")))


def has_errors(findings: DataFrame) -> Column | bool:
    return bool(findings.agg(F.coalesce(F.bool_or(F.col("severity") == "error"), F.lit(False))).first()[0])


# --- report -----------------------------------------------------------------------------------


def totals(findings: DataFrame, sections: DataFrame) -> DataFrame:
    """Counts by severity for each section and for all (section null), with PASS or FAIL; empty sections show zeros.

    Findings are counted before they meet the sections: a join by section would put all of one into one task.
    """
    counted = findings.groupBy("section").agg(*(F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in vocab.SEVERITIES))
    sums = [F.coalesce(F.sum(f"n_{s}"), F.lit(0)).cast("bigint").alias(f"n_{s}") for s in vocab.SEVERITIES]
    rolled = sections.join(counted, "section", "left").rollup("section").agg(*sums)
    return rolled.withColumn("verdict", F.when(F.col("n_error") > 0, "FAIL").otherwise("PASS"))


def schema_drift(producer: DataFrame, consumer: DataFrame) -> DataFrame:
    """(field, rule) where two field lists (field, types, format, required, extra) disagree.

    Rules: a field missing on either side, no common type, another format, required on one side
    only, other handling of additional properties.
    """
    side = lambda df, p: df.select("field", *(F.col(c).alias(f"{p}_{c}") for c in ("types", "format", "required", "extra")))
    both = side(producer, "p").join(side(consumer, "c"), "field", "full_outer")
    here, there = F.col("p_types").isNotNull(), F.col("c_types").isNotNull()
    rules = F.array(
        F.when(~there, "missing_in_consumer"),
        F.when(~here, "missing_in_producer"),
        F.when(here & there & ~F.arrays_overlap("p_types", "c_types"), "types_disjoint"),
        F.when(here & there & ~F.col("p_format").eqNullSafe(F.col("c_format")), "format_differs"),
        F.when(here & there & (F.col("p_required") != F.col("c_required")), "required_differs"),
        F.when(here & there & ~F.col("p_extra").eqNullSafe(F.col("c_extra")), "extra_differs"),
    )
    return both.select("field", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("rule"))
