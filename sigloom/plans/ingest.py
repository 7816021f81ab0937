"""Feeds, loaders, field rules, coercion and sinks over the driver's tables.

Documents are built from rows by concatenation, one document a row, so that both sides see the same
texts and no document grows with its table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import api, sinks, vocab
from ..functions import scalar, text
from ..operators import discovery, extraction, fields, gate, graph, integrity, metrics, state
from ..session import kept, load
from ..sources import config, documents, feeds
from .registry import query

def _none():
    return F.lit(None).cast("string")


def _text(*parts):
    """A text from literals and columns; columns are marked by a tuple."""
    return F.concat(*(F.col(p[0]).cast("string") if isinstance(p, tuple) else F.lit(p) if isinstance(p, str) else p for p in parts))


def _pick(column, modulus, values):
    """The value for each remainder; the last one for all others."""
    out = None
    for i, v in enumerate(values[:-1]):
        hit = F.col(column) % modulus == i
        out = F.when(hit, v) if out is None else out.when(hit, v)
    return out.otherwise(values[-1])


# --- feeds ------------------------------------------------------------------------------------


def _feeds(spark, sf_dir):
    """RSS and Atom by turns, RDF now and then, every fifth one torn off."""
    k = ("p_partkey",)
    item = (" <item><title> &lt;b&gt;", ("p_name",), "&lt;/b&gt;  new</title><link> https://e.org/", k, " </link><pubDate>Mon, ", (F.col("p_partkey") % 28 + 1).cast("string"), " Jan 2026 10:00:00 GMT</pubDate></item>")
    rss = _text('<?xml version="1.0"?><rss version="2.0"><channel><title>f</title>', *item, "<item><title>no link</title></item></channel></rss>")
    atom = _text(
        '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>', ("p_name",), '</title><link rel="self" href="https://e.org/self"/><link href="https://e.org/a', k,
        '"/><summary>s</summary><updated>2026-01-05T10:00:00Z</updated></entry></feed>',
    )
    whole = F.when(F.col("p_partkey") % 2 == 0, rss).otherwise(atom)
    torn = F.when(F.col("p_partkey") % 5 == 0, F.substring(whole, F.lit(1), F.length(whole) - 20)).otherwise(whole)
    return load(spark, sf_dir, "part").select(F.col("p_partkey").alias("feed_url"), F.encode(torn, "utf-8").alias("content"))


@query(
    """
    select p_partkey as feed_url, case p_partkey % 2 when 0 then 'https://e.org/' else 'https://e.org/a' end || p_partkey as url,
           p_name || case p_partkey % 2 when 0 then ' new' else '' end as title,
           epoch(case p_partkey % 2 when 0 then timestamp '2026-01-01 10:00:00' + to_days((p_partkey % 28)::integer) else timestamp '2026-01-05 10:00:00' end)::bigint as published
    from part where p_partkey % 5 <> 0
    """
)
def q45_feed_entries(spark, sf_dir):
    found = feeds.entries(_feeds(spark, sf_dir))
    return found.select("feed_url", "url", "title", F.unix_seconds("published_at").alias("published"))


@query("select p_partkey as feed_url, 'malformed feed without entries' as error from part where p_partkey % 5 = 0")
def q46_feed_failures(spark, sf_dir):
    return feeds.failures(_feeds(spark, sf_dir))


_TYPED = "t as (select s_suppkey as k, case when s_suppkey % 7 = 0 then 'html' else ['rss', 'atom', 'rss', 'html', 'atom', 'html'][s_suppkey % 6 + 1] end as feed_type from supplier)"


def _typed(spark, sf_dir):
    s = load(spark, sf_dir, "supplier")
    url = _text("https://s/", ("s_suppkey",))
    sources = s.select(
        url.alias("url"), _text("L", ("s_suppkey",)).alias("label"), F.lit("medium").alias("task"), F.lit(100).alias("max_chars"), F.array(F.lit("p")).alias("pir_ids"),
        F.when(F.col("s_suppkey") % 7 == 0, "html").alias("feed_type"),
    )
    kinds = ["application/rss+xml; charset=x", "Application/Atom+XML", " text/xml ;q", "text/html", "application/xml", None]
    probed = s.select(
        url.alias("url"),
        _pick("s_suppkey", 6, [F.lit(k) for k in kinds]).alias("content_type"),
        F.encode(_pick("s_suppkey", 3, [F.lit("x"), F.lit("<FEED>"), F.lit("<?xml?><rss>")]), "utf-8").alias("content"),
        F.when(F.col("s_suppkey") % 6 == 5, "status 500").alias("error"),
    )
    return s, config.typed_sources(sources, probed)


@query(f"with {_TYPED} select 'https://s/' || k as url, feed_type from t")
def q47_feed_types(spark, sf_dir):
    return _typed(spark, sf_dir)[1].select("url", "feed_type")


@query(
    f"""with {_TYPED} select 'https://s/' || k || case feed_type when 'html' then '' else '/1' end as url,
           'L' || k || case when feed_type <> 'html' and k % 4 <> 0 then ': t' || k else '' end as label, 'medium' as task, 100 as max_chars, 'p' as pir_ids, 'html' as feed_type
    from t"""
)
def q48_expanded_sources(spark, sf_dir):
    s, typed = _typed(spark, sf_dir)
    url = _text("https://s/", ("s_suppkey",))
    found = s.select(url.alias("feed_url"), F.concat(url, F.lit("/1")).alias("url"), F.when(F.col("s_suppkey") % 4 != 0, _text("t", ("s_suppkey",))).alias("title"))
    return feeds.expanded(typed, found).withColumn("pir_ids", F.array_join("pir_ids", ","))


# --- loaders ----------------------------------------------------------------------------------


@query(
    """
    select 'u' || c_custkey as url, c_name as content_sha256, (c_custkey % 10) / 10.0::double as score, (case c_custkey % 3 when 0 then 0 else 1 end)::integer as n_iocs,
           case c_custkey % 3 when 0 then null else c_mktsegment end as value
    from customer where c_custkey % 11 <> 0
    """
)
def q49_state_load(spark, sf_dir):
    iocs = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(_text(',"iocs":[{"type":"fqdn","value":"', ("c_mktsegment",), '","confidence":0.5,"context_snippet":""}]'))
    raw = load(spark, sf_dir, "customer").select(
        _text(
            '{"version":', F.when(F.col("c_custkey") % 11 == 0, "2").otherwise("1"), ',"entries":{"u', ("c_custkey",), '":{"first_seen":"2025-01-01T00:00:00.000Z","last_seen":"2025-01-02T00:00:00.000Z",'
            '"content_sha256":"', ("c_name",), '","bundle_path":null,"relevance":{"decision":"kept","score":0.', (F.col("c_custkey") % 10).cast("string"), ',"matched_pir_ids":[],"rationale":"","pir_set_hash":"h"}', iocs, "}}}",
        ).alias("value")
    )
    got = documents.load_state(raw)
    return got.select("url", "content_sha256", F.col("relevance.score").alias("score"), F.size("iocs").alias("n_iocs"), F.get("iocs", F.lit(0))["value"].alias("value"))


_PIR_TEXT = """'{"schema_version":"' || ['2.0.0', '1.0.0', '9'][c_custkey % 3 + 1] || '","pirs":[{"pir_id":"p' || c_custkey || '","threat_actor_tags":["' || c_mktsegment || '"]},{"pir_id":"q"}]}'"""


def _pirs(spark, sf_dir):
    version = _pick("c_custkey", 3, [F.lit("2.0.0"), F.lit("1.0.0"), F.lit("9")])
    wrapped = _text('{"schema_version":"', version, '","pirs":[{"pir_id":"p', ("c_custkey",), '","threat_actor_tags":["', ("c_mktsegment",), '"]},{"pir_id":"q"}]}')
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("path"), F.when(F.col("c_custkey") % 4 == 3, '[{"pir_id":"p"}]').otherwise(wrapped).alias("value")
    )


@query(
    f"""
    with t as (select c_custkey, c_mktsegment, {_PIR_TEXT} as t from customer where c_custkey % 4 <> 3)
    select sha256(t) as pir_set_hash, 0 as pos, 'p' || c_custkey as pir_id, c_mktsegment as tags from t union all select sha256(t), 1, 'q', null from t
    """
)
def q50_requirements(spark, sf_dir):
    got = documents.load_pirs(_pirs(spark, sf_dir))
    return got.select("pir_set_hash", "pos", "pir_id", F.array_join("threat_actor_tags", ",").alias("tags"))


@query(
    """
    select c_custkey::varchar as path, case when c_custkey % 4 = 3 then 'PIR_SCHEMA_ENVELOPE' else 'PIR_SCHEMA' end as code,
           case when c_custkey % 4 = 3 then c_custkey::varchar else 'schema_version' end as location,
           case when c_custkey % 4 = 3 then 'the list must be wrapped as pirs beside a schema_version'
                when c_custkey % 3 = 1 then 'schema_version 1.0.0 is no longer read; produce 2.0.0' else 'schema_version 9 is not known' end as message
    from customer where c_custkey % 4 = 3 or c_custkey % 3 <> 0
    """
)
def q51_requirement_envelopes(spark, sf_dir):
    return documents.pir_errors(_pirs(spark, sf_dir)).select("path", "code", "location", "message")


_MARK = "marking-definition--" + "5e57c739-391a-4eb3-b6be-7d15ca92d5ed"


def _bundle_texts(spark, sf_dir):
    """A bundle an order: an actor, a malware with a kill chain, an internal identity and an edge, each wrong now and then."""
    k = ("o_orderkey",)
    n = F.col("o_orderkey")
    return load(spark, sf_dir, "orders").select(
        n.cast("string").alias("path"),
        _text(
            '{"type":"', F.when(n % 10 == 0, "report").otherwise("bundle"), '","id":"bundle--', k, '"', F.when(n % 5 == 0, f',"object_marking_refs":["{_MARK}"]').otherwise(""),
            ',"objects":[{"type":"threat-actor","id":"threat-actor--', k, '","name":" GROUP ', (n % 4).cast("string"), '","aliases":["Other ', (n % 3).cast("string"), '"],"labels":["base"]},',
            '{"type":"malware","id":"malware--', F.when(n % 7 == 0, "same").otherwise(n.cast("string")), '","name":"m","kill_chain_phases":[{"kill_chain_name":"', F.when(n % 6 == 0, "other").otherwise("mitre-attack"), '","phase_name":"x"}]},',
            F.when(n % 7 == 0, '{"type":"tool","id":"malware--same","name":"t"},').otherwise(""),
            f'{{"type":"{vocab.IDENTITY_NODE}","id":"{vocab.IDENTITY_NODE}--', k, '","identity_id":"i', (n % 4).cast("string"), '"},',
            '{"type":"relationship","id":"relationship--', k, '","relationship_type":"', F.when(n % 3 == 0, "attributed-to").otherwise("uses"), '","source_ref":"threat-actor--', k, '"', F.when(n % 9 == 0, "").otherwise(_text(',"target_ref":"malware--', F.when(n % 7 == 0, "same").otherwise(n.cast("string")), '"')), "}]}",
        ).alias("value"),
    )


@query(
    f"""
    with o as (select o_orderkey as k, case when o_orderkey % 7 = 0 then 1 else 0 end as more from orders)
    select k::varchar as bundle_id, 0 as pos, 'threat-actor' as type, ' GROUP ' || (k % 4) as name from o
    union all select k::varchar, 1, 'malware', 'm' from o union all select k::varchar, 2, 'tool', 't' from o where more = 1
    union all select k::varchar, 2 + more, '{vocab.IDENTITY_NODE}', null from o union all select k::varchar, 3 + more, 'relationship', case when k % 3 = 0 then 'attributed-to' else 'uses' end from o
    """
)
def q52_bundle_objects(spark, sf_dir):
    _, nodes, edges = documents.load_bundles(_bundle_texts(spark, sf_dir))
    return nodes.select("bundle_id", "pos", "type", "name").unionByName(
        edges.select("bundle_id", "pos", F.lit("relationship").alias("type"), F.col("relationship_type").alias("name"))
    )


@query("select o_orderkey::varchar as bundle_path, case when o_orderkey % 5 = 0 then 'red' end as tlp from orders where o_orderkey % 5 = 0")
def q53_bundle_markings(spark, sf_dir):
    return gate.bundle_tlp(documents.markings(_bundle_texts(spark, sf_dir)))


@query(
    f"""
    with o as (select o_orderkey as k, case when o_orderkey % 7 = 0 then 1 else 0 end as more from orders)
    select 'error' as severity, 'BUNDLE_TYPE' as code, 'bundle.type' as location, count(*) as n from o where k % 10 = 0 having count(*) > 0
    union all select 'error', 'STIX_ID_NOT_UNIQUE', 'objects[*].id=malware--same', count(*) from o where more = 1 having count(*) > 0
    union all select 'error', 'REL_REF_MISSING', 'objects[' || (3 + more) || '].target_ref', count(*) from o where k % 9 = 0 group by more
    union all select 'error', 'KILL_CHAIN_NAME', 'objects[1].kill_chain_phases[0].kill_chain_name', count(*) from o where k % 6 = 0 having count(*) > 0
    union all select 'error', 'RELATIONSHIP_TYPE_MATCH', 'relationship id=relationship--' || k, 1 from o where k % 3 = 0
    union all select 'error', 'IDENTITY_REF_RESOLUTION', '{vocab.IDENTITY_NODE} id={vocab.IDENTITY_NODE}--' || k, 1 from o where k % 4 > 1
    """
)
def q54_bundle_rules(spark, sf_dir):
    known = spark.createDataFrame([("i0",), ("i1",)], "id string")
    found = api.validate_bundle(_bundle_texts(spark, sf_dir), strict=True, known_identities=known)
    return found.groupBy("severity", "code", "location").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    with o as (select o_orderkey as k from orders)
    select k::varchar as path, (case when k % 4 = 1 or k % 3 = 2 then 1 else 0 end)::bigint as n_enriched,
           'base' || case when k % 4 = 1 then ',t1,t2' else '' end || case when k % 3 = 2 then case when k % 4 = 1 then ',t3' else ',t2,t3' end else '' end as labels,
           (4 + case when k % 7 = 0 then 1 else 0 end)::integer as n_objects from o
    """
)
def q55_enriched_bundles(spark, sf_dir):
    taxonomy = spark.createDataFrame([("group 1", "t1", 0), ("group 1", "t2", 1), ("other 2", "t2", 2), ("other 2", "t3", 3)], "group_norm string, tag string, ord int")
    done = api.enrich_bundle_texts(_bundle_texts(spark, sf_dir), taxonomy)
    doc = F.from_json("value", "struct<objects:array<struct<labels:array<string>>>>")
    return done.select("path", "n_enriched", F.array_join(F.get(doc["objects"], F.lit(0))["labels"], ",").alias("labels"), F.size(doc["objects"]).alias("n_objects"))


# --- field rules ------------------------------------------------------------------------------


@query(
    """
    with s as (select s_suppkey as k from supplier), f as (
        select k, 'assets.0.name' as location, 'name is empty' as message from s where k % 3 = 0
        union all select k, 'assets.0.criticality', 'criticality is above 10' from s where k % 4 = 1
        union all select k, 'assets.0.criticality', 'criticality is not a number' from s where k % 4 = 2
        union all select k, 'assets.0.bogus', 'bogus is not known' from s where k % 5 = 0
        union all select k, 'assets.1', 'is not an object' from s where k % 7 = 0
        union all select k, 'network_segments.0.cidr', 'cidr is missing' from s where k % 2 = 0
        union all select k, 'asset_connections.0.port', 'port is above 65535' from s where k % 6 = 5
        union all select k, 'actor_targets.0.confidence', 'confidence is not an integer' from s where k % 8 = 1
        union all select k, 'security_controls', 'security_controls is not a list' from s where k % 9 = 0)
    select k::varchar as path, 'ASSETS_SCHEMA' as code, location, message from f
    """
)
def q56_asset_fields(spark, sf_dir):
    n = F.col("s_suppkey")
    value = _text(
        '{"_comment":"x","network_segments":[{"id":"n","name":"n","zone":"z"', F.when(n % 2 == 0, "").otherwise(',"cidr":"10.0.0.0/8"'), '}],"assets":[{"id":"a","name":"', F.when(n % 3 == 0, "  ").otherwise("x"),
        '","owner":null,"tags":[],"criticality":', _pick("s_suppkey", 4, [F.lit("5"), F.lit("10.5"), F.lit('"high"'), F.lit('"7"')]), F.when(n % 5 == 0, ',"bogus":1').otherwise(""), "}", F.when(n % 7 == 0, ',"text"').otherwise(""),
        '],"asset_connections":[{"src":"a","dst":"a","port":', F.when(n % 6 == 5, "70000").otherwise("443"), '}],"actor_targets":[{"actor_stix_id_ref":"t","asset_id":"a","confidence":', F.when(n % 8 == 1, "1.5").otherwise("50"),
        '}],"security_controls":', F.when(n % 9 == 0, "{}").otherwise("[]"), "}",
    )
    raw = load(spark, sf_dir, "supplier").select(n.alias("path"), value.alias("value"))
    return fields.check(raw, "assets").select("path", "code", "location", "message")


@query(
    """
    with c as (select c_custkey as k from customer), f as (
        select k, 'identities.0.identity_class' as location, 'identity_class is not in its vocabulary' as message from c where k % 3 = 0
        union all select k, 'identities.0.description', 'description is not a string' from c where k % 4 = 0
        union all select k, 'has_access.0', 'granted_at must precede revoked_at' from c where k % 5 = 0
        union all select k, 'has_access.0.access_level', 'access_level is not in its vocabulary' from c where k % 7 = 0
        union all select k, 'version', 'version is below 1' from c where k % 11 = 0)
    select k::varchar as path, 'IDENTITY_ASSETS_SCHEMA' as code, location, message from f
    """
)
def q57_identity_fields(spark, sf_dir):
    n = F.col("c_custkey")
    value = _text(
        '{"version":', F.when(n % 11 == 0, "0").otherwise("1"), ',"more":1,"identities":[{"id":"i","name":"n","identity_class":"', F.when(n % 3 == 0, "robot").otherwise("group"), '","description":', F.when(n % 4 == 0, "null").otherwise('""'),
        '}],"has_access":[{"identity_id":"i","asset_id":"a","access_level":"', F.when(n % 7 == 0, "root").otherwise("read"), '","granted_at":"2026-01-02","revoked_at":"', _pick("c_custkey", 5, [F.lit("2026-01-02"), F.lit(""), F.lit("2026-02-01")]), '"}]}',
    )
    raw = load(spark, sf_dir, "customer").select(n.alias("path"), value.alias("value"))
    return fields.check(raw, "identity_assets").select("path", "code", "location", "message")


@query(
    """
    with c as (select c_custkey as k from customer), f as (
        select k, 'user_accounts.0.account_type' as location, 'account_type is not in its vocabulary' as message from c where k % 3 = 0
        union all select k, 'user_accounts.0.is_privileged', 'is_privileged is not true or false' from c where k % 4 = 0
        union all select k, 'account_on_asset.0', 'first_seen must precede last_seen' from c where k % 5 = 0
        union all select k, 'account_on_asset.0.asset_id', 'asset_id is missing' from c where k % 6 = 1)
    select k::varchar as path, 'USER_ACCOUNTS_SCHEMA' as code, location, message from f
    """
)
def q58_account_fields(spark, sf_dir):
    n = F.col("c_custkey")
    value = _text(
        '{"user_accounts":[{"id":"u","account_login":"l","account_type":"', F.when(n % 3 == 0, "saas").otherwise("unix"), '","is_privileged":', F.when(n % 4 == 0, '"maybe"').otherwise("true"),
        '}],"account_on_asset":[{"user_account_id":"u"', F.when(n % 6 == 1, "").otherwise(',"asset_id":"a"'), ',"first_seen":"2026-01-02","last_seen":"', F.when(n % 5 == 0, "2026-01-01").otherwise("2026-01-03"), '"}]}',
    )
    raw = load(spark, sf_dir, "customer").select(n.alias("path"), value.alias("value"))
    return fields.check(raw, "user_accounts").select("path", "code", "location", "message")


@query(
    """
    with p as (select p_partkey as k from part), f as (
        select k, 'pirs.0' as location, 'valid_from must precede valid_until' as message from p where k % 3 = 0
        union all select k, 'pirs.0.valid_until', 'valid_until is not a date' from p where k % 3 = 1
        union all select k, 'pirs.0.asset_weight_rules.0.criticality_multiplier', 'criticality_multiplier is not above 0' from p where k % 4 = 0
        union all select k, 'pirs.0.prioritized_actors', 'prioritized_actors is missing' from p where k % 5 = 0
        union all select k, 'pirs.0.prioritized_actors.0.likelihood', 'likelihood is above 1' from p where k % 5 = 1
        union all select k, 'pirs.0.prioritized_actors.0.score_breakdown.capability', 'capability is missing' from p where k % 5 = 2
        union all select k, 'pirs.0.prioritized_actors.0.score_breakdown.intent.luck', 'luck is not known' from p where k % 7 = 0 and k % 5 <> 0
        union all select k, 'pirs.0.prioritized_actors.0.rationale.text', 'text is missing' from p where k % 6 = 0 and k % 5 <> 0)
    select k::varchar as path, 'PIR_SCHEMA' as code, location, message from f
    """
)
def q59_requirement_fields(spark, sf_dir):
    n = F.col("p_partkey")
    actor = _text(
        '{"actor_id":"a","name":"n","more":1,"likelihood":', F.when(n % 5 == 1, "1.5").otherwise("0.5"), ',"score_breakdown":{"intent":{"score":1', F.when(n % 7 == 0, ',"luck":1').otherwise(""), '},"opportunity":{"score":0}',
        F.when(n % 5 == 2, "").otherwise(',"capability":{"score":0.5,"depth":null}'), '},"rationale":{', F.when(n % 6 == 0, "").otherwise('"text":""'), "}}",
    )
    value = _text(
        '{"schema_version":"2.0.0","pirs":[{"pir_id":"p","valid_from":"2026-01-02","valid_until":"', _pick("p_partkey", 3, [F.lit("2026-01-02"), F.lit("soon"), F.lit("2026-03-01")]), '","asset_weight_rules":[{"tag":"t","criticality_multiplier":',
        F.when(n % 4 == 0, "0").otherwise("1.5"), "}]", F.when(n % 5 == 0, "").otherwise(F.concat(F.lit(',"prioritized_actors":['), actor, F.lit("]"))), "}]}",
    )
    raw = load(spark, sf_dir, "part").select(n.alias("path"), value.alias("value"))
    return fields.check(raw, "pir").select("path", "code", "location", "message")


@query(
    """
    with s as (select s_suppkey as k from supplier), f as (
        select k, 'sources.0.task' as location, 'task is not in its vocabulary' as message from s where k % 3 = 0
        union all select k, 'sources.0.max_chars', 'max_chars is not above 0' from s where k % 4 = 0
        union all select k, 'sources.0.feed_type', 'feed_type is not in its vocabulary' from s where k % 5 = 0
        union all select k, 'sources.0.url', 'url is empty' from s where k % 7 = 0
        union all select k, 'owner', 'owner is not known' from s where k % 2 = 0)
    select k::varchar as path, 'SOURCES_SCHEMA' as code, location, message from f
    """
)
def q60_source_fields(spark, sf_dir):
    n = F.col("s_suppkey")
    value = _text(
        '{"version":1', F.when(n % 2 == 0, ',"owner":"x"').otherwise(""), ',"sources":[{"url":"', F.when(n % 7 == 0, "").otherwise("https://x"), '","task":"', F.when(n % 3 == 0, "huge").otherwise("simple"), '","max_chars":',
        F.when(n % 4 == 0, "0").otherwise("null"), ',"feed_type":', F.when(n % 5 == 0, '"json"').otherwise("null"), "}]}",
    )
    raw = load(spark, sf_dir, "supplier").select(n.alias("path"), value.alias("value"))
    return fields.check(raw, "sources").select("path", "code", "location", "message")


# --- references of inventories ----------------------------------------------------------------


def _assets(spark, sf_dir):
    """Suppliers as assets of nations as segments; parts as controls, orders' customers as connections."""
    s, n, r = (load(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    k = F.col("s_suppkey")
    assets = s.select(
        k.alias("pos"), k.cast("string").alias("id"), F.col("s_name").alias("name"), F.lit(5.0).alias("criticality"), F.col("s_nationkey").cast("string").alias("network_segment_id"),
        F.array((k % 7).cast("string"), F.lit("1")).alias("security_control_ids"), F.array((k % 3).cast("string")).alias("tags"),
    )
    return {
        "assets": assets,
        "network_segments": n.where("n_nationkey < 20").select(F.col("n_nationkey").alias("pos"), F.col("n_nationkey").cast("string").alias("id")),
        "security_controls": r.select(F.col("r_regionkey").alias("pos"), (F.col("r_regionkey") % 4).cast("string").alias("id")),
        "asset_vulnerabilities": s.select(k.alias("pos"), (k * 2).cast("string").alias("asset_id")),
        "asset_connections": s.select(k.alias("pos"), k.cast("string").alias("src"), (k + 5).cast("string").alias("dst"), F.lit(1).alias("port")),
        "actor_targets": s.select(k.alias("pos"), (k - 1).cast("string").alias("asset_id"), F.lit(1).alias("confidence")),
    }


@query(
    """
    with s as (select s_suppkey as k, s_nationkey as n from supplier)
    select 'ASSET_REF_SEGMENT' as code, 'assets[' || k || ']' as location from s where n >= 20
    union all select 'ASSET_REF_CONTROL', 'assets[' || k || '].security_control_ids[0]' from s where k % 7 > 3
    union all select 'VULN_REF_ASSET', 'asset_vulnerabilities[' || k || ']' from s where k * 2 not in (select k from s)
    union all select 'ACTOR_TARGET_REF_ASSET', 'actor_targets[' || k || ']' from s where k - 1 not in (select k from s)
    union all select 'CONNECTION_REF_ASSET', 'asset_connections[' || k || '].dst' from s where k + 5 not in (select k from s)
    union all select 'ID_NOT_UNIQUE', 'security_controls' from (select r_regionkey % 4 as i from region group by 1 having count(*) > 1)
    """
)
def q61_asset_references(spark, sf_dir):
    return integrity.check_assets(_assets(spark, sf_dir)).select("code", "location")


@query(
    """
    with c as (select c_custkey as k from customer), s as (select s_suppkey as k from supplier)
    select 'error' as severity, 'HAS_ACCESS_REF_IDENTITY' as code, 'has_access[' || k || ']' as location from c where k + 3 not in (select k from c)
    union all select 'error', 'HAS_ACCESS_REF_ASSET', 'has_access[' || k || ']' from c where k % 20 not in (select k from s)
    union all select 'warning', 'HAS_ACCESS_DUPLICATE_PAIR', 'has_access' from (select k // 1000000 as x from c where false)
    """
)
def q62_access_references(spark, sf_dir):
    k = F.col("c_custkey")
    c = load(spark, sf_dir, "customer")
    t = {"identities": c.select(k.alias("pos"), k.cast("string").alias("id")), "has_access": c.select(k.alias("pos"), (k + 3).cast("string").alias("identity_id"), (k % 20).cast("string").alias("asset_id"))}
    return integrity.check_identities(t, _assets(spark, sf_dir)["assets"]).select("severity", "code", "location")


@query(
    """
    with c as (select c_custkey as k from customer), s as (select s_suppkey as k from supplier)
    select 'error' as severity, 'USER_ACCOUNT_REF_IDENTITY' as code, 'user_accounts[' || k || ']' as location from c where k % 2 = 0 and k + 4 not in (select k from c)
    union all select 'error', 'ACCOUNT_ON_ASSET_REF_USER_ACCOUNT', 'account_on_asset[' || k || ']' from c where k // 2 + 100 not in (select k from c)
    union all select 'error', 'ACCOUNT_ON_ASSET_REF_ASSET', 'account_on_asset[' || k || ']' from c where 3 not in (select k from s)
    union all select 'warning', 'ACCOUNT_ON_ASSET_DUPLICATE_PAIR', 'account_on_asset' from (select k // 2 as x from c group by 1 having count(*) > 1)
    """
)
def q63_account_references(spark, sf_dir):
    k = F.col("c_custkey")
    c = load(spark, sf_dir, "customer")
    owner = F.when(k % 2 == 0, (k + 4).cast("string")).otherwise("")
    t = {
        "user_accounts": c.select(k.alias("pos"), k.cast("string").alias("id"), owner.alias("identity_id")),
        "account_on_asset": c.select(k.alias("pos"), (F.floor(k / 2) + 100).cast("string").alias("user_account_id"), F.lit("3").alias("asset_id")),
    }
    return integrity.check_accounts(t, _assets(spark, sf_dir)["assets"], c.select(k.cast("string").alias("id"))).select("severity", "code", "location")


@query(
    """
    with p as (select p_partkey as k, p_type as t, p_size as z from part)
    select 'warning' as severity, 'PIR_TAG_NOT_IN_TAXONOMY' as code, 'pir[' || k || '].threat_actor_tags[0]' as location from p where t not in ('ECONOMY', 'PROMO')
    union all select 'error', 'PIR_RULE_TAG_UNUSED', 'pir[' || k || '].asset_weight_rules[1]' from p where z % 5 > 2
    union all select 'error', 'PIR_ID_NOT_UNIQUE', 'pir[*].pir_id' from (select k // 2 from p group by 1 having count(*) > 1)
    """
)
def q64_requirement_references(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    rule = lambda tag: F.struct(tag.alias("tag"), F.lit(1.0).alias("criticality_multiplier"))
    pirs = p.select(
        F.col("p_partkey").alias("pos"), F.floor(F.col("p_partkey") / 2).alias("pir_id"), F.array("p_type").alias("threat_actor_tags"),
        F.array(rule(F.lit("0")), rule((F.col("p_size") % 5).cast("string"))).alias("asset_weight_rules"),
    )
    tags = spark.createDataFrame([("ECONOMY",), ("PROMO",)], "tag string")
    return integrity.check_pirs(pirs, tags, _assets(spark, sf_dir)["assets"]).select("severity", "code", "location")


# --- coercion and assembly --------------------------------------------------------------------


def _responses(spark, sf_dir):
    """A response a turn of conversation, with entries of every kind, some of them wrong."""
    n, k = F.col("turn"), ("turn",)
    kind = _pick("turn", 4, [F.lit("malware"), F.lit("gadget"), F.lit("tool"), F.lit("identity")])
    value = _text(
        '{"entities":[{"local_id":"', F.when(n % 5 == 4, "").otherwise(F.concat(F.lit("e"), n)), '","type":"', kind, '","name":"N', k, '"},{"local_id":"i","type":"identity","name":"Who"}],',
        '"relationships":[{"source":"e', k, '","target":"i","relationship_type":"', F.when(n % 3 == 0, "likes").otherwise("targets"), '"},{"source":"i","target":"","relationship_type":"uses"}],',
        '"identity_asset_edges":[{"source":"i","asset_reference":" nation_', (n % 5).cast("string"), ' ","description":"d"},{"source":"i","asset_reference":"  "}],',
        '"user_account_observations":[{"account_login":" user', k, ' ","account_type":"', F.when(n % 2 == 0, "unix").otherwise("saas"), '","identity_local_id":"i","asset_references":[" nation_1 ","","NATION_2"]},{"account_login":"  "}],',
        '"identity_relationship_edges":[{"source":"e', k, '","relationship_type":"', F.when(n % 2 == 0, "impersonates").otherwise("uses"), '","target_identity_reference":"NATION_', (n % 4).cast("string"), '","confidence":40}]}',
    )
    raw = load(spark, sf_dir, "conversations").select(F.concat_ws("/", "conv_id", "turn").alias("doc_id"), F.lit(0).alias("chunk"), value.alias("json"))
    return extraction.parsed(raw)


_CONV = "c as (select conv_id || '/' || turn as d, turn as n from conversations)"


@query(
    f"""with {_CONV}
    select d as doc_id, 0 as ord, 'c0_e' || n as alias, ['malware', '', 'tool', 'identity'][n % 4 + 1] as type, 'N' || n as name from c where n % 4 <> 1 and n % 5 <> 4
    union all select d, 1, 'c0_i', 'identity', 'Who' from c"""
)
def q65_entities(spark, sf_dir):
    return extraction.entities(_responses(spark, sf_dir)).select("doc_id", "ord", "alias", "type", "name")


@query(
    f"""with {_CONV}
    select d as doc_id, 'relationship' as kind, 'c0_e' || n as source, 'targets' as what, 'c0_i' as target from c where n % 3 <> 0
    union all select d, 'access', 'c0_i', 'd', 'nation_' || (n % 5) from c
    union all select d, 'identity', 'c0_e' || n, 'impersonates', 'NATION_' || (n % 4) from c where n % 2 = 0
    union all select d, 'account', 'user' || n, case n % 2 when 0 then 'unix' else '' end, 'nation_1,NATION_2' from c"""
)
def q66_coerced_edges(spark, sf_dir):
    r = _responses(spark, sf_dir)
    row = lambda kind, source, what, target: ("doc_id", F.lit(kind).alias("kind"), F.col(source).alias("source"), what.alias("what"), target.alias("target"))
    return (
        extraction.relationships(r).select(*row("relationship", "source", F.col("relationship_type"), F.col("target")))
        .unionByName(extraction.asset_edges(r).select(*row("access", "source", F.col("description"), text.strip("asset_reference"))))
        .unionByName(extraction.identity_edges(r).select(*row("identity", "source", F.col("relationship_type"), F.col("target_identity_reference"))))
        .unionByName(extraction.accounts(r).select(*row("account", "account_login", F.col("account_type"), F.array_join("asset_references", ","))))
    )


def _graph(spark, sf_dir):
    r = _responses(spark, sf_dir)
    entities = extraction.entities(r)
    merged, aliases = extraction.merge_entities(entities, api.SCALARS, api.LISTS)
    x = api.Extraction(
        merged,
        extraction.merge_relationships(extraction.relationships(r), aliases),
        extraction.merge_asset_edges(extraction.asset_edges(r), aliases),
        extraction.merge_accounts(extraction.accounts(r), aliases),
        extraction.merge_asset_edges(extraction.identity_edges(r).withColumn("asset_reference", F.col("target_identity_reference")), aliases).drop("asset_reference"),
        entities,
    )
    x = api.Extraction(**{name: kept(table, name) for name, table in vars(x).items()})
    n = load(spark, sf_dir, "nation")
    none = F.array().cast("array<string>")
    assets = n.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"), none.alias("tags"))
    people = n.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"), none.alias("roles"), none.alias("sectors"))
    return x, api.assemble(x, F.lit("2026-01-01").cast("timestamp"), assets, people)


@query(
    f"""with {_CONV}, e as (select d, n, ['malware', '', 'tool', 'identity'][n % 4 + 1] as t from c where n % 4 <> 1 and n % 5 <> 4),
    edges(doc_id, a, b, c, n) as (
        select d, 'targets', t, 'identity', null::bigint from e where n % 3 <> 0 and t <> 'identity'
        union all select d, '{vocab.HAS_ACCESS}', 'identity', '{vocab.ASSET_NODE}', 80 from c
        union all select d, 'related-to', 'user-account', 'identity', null from c
        union all select d, '{vocab.VALID_ON}', 'user-account', '{vocab.ASSET_NODE}', 80 from c, (values (1), (2))
        union all select d, 'impersonates', t, '{vocab.IDENTITY_NODE}', 40 from e where n % 2 = 0),
    nodes(t) as (
        select t from e union all select 'identity' from c union all select 'user-account' from c union all select 'observed-data' from c
        union all select '{vocab.ASSET_NODE}' from c, (values (1), (2)) union all select '{vocab.ASSET_NODE}' from c where n % 5 not in (1, 2)
        union all select '{vocab.IDENTITY_NODE}' from e where n % 2 = 0)
    select 'edge' as part, * from edges
    union all select 'node', null, t, null, null, count(*) from nodes group by t
    union all select 'counter', null, 'raw', null, null, (select count(*) from e) + (select count(*) from c)
    union all select 'counter', null, 'merged', null, null, (select count(*) from e) + (select count(*) from c)
    union all select 'counter', null, 'type_mismatch', null, null, count(*) from e where n % 3 <> 0 and t = 'identity' having count(*) > 0
    union all select 'counter', null, 'kept', null, null, count(*) from e where n % 3 <> 0 and t <> 'identity'"""
)
def q67_assembly(spark, sf_dir):
    """Edges by the types of their ends, nodes by type, and what was merged, kept and dropped."""
    x, (nodes, edges, lost) = _graph(spark, sf_dir)
    edges = kept(edges, "edges")
    kind = lambda ref: F.split_part(ref, F.lit("--"), F.lit(1))
    sums = extraction.merge_counters(x.raw_entities, x.entities).agg(F.sum("raw").alias("raw"), F.sum("merged").alias("merged"))
    flat = sums.select(F.expr("stack(2, 'raw', raw, 'merged', merged) as (what, n)"))
    targets = edges.where("relationship_type = 'targets'").withColumn("all", F.lit(1))
    drops = metrics.drop_counts(targets, lost.withColumn("all", F.lit(1)), ["all"]).select(F.col("reason").alias("what"), "n")
    row = lambda part, doc, a, b, c, n: (F.lit(part).alias("part"), doc.alias("doc_id"), a.alias("a"), b.alias("b"), c.alias("c"), n.cast("bigint").alias("n"))
    counted = nodes.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    return (
        edges.select(*row("edge", F.col("doc_id"), F.col("relationship_type"), kind("source_ref"), kind("target_ref"), F.col("confidence")))
        .unionByName(counted.select(*row("node", _none(), F.col("type"), _none(), _none(), F.col("n"))))
        .unionByName(flat.unionByName(drops).select(*row("counter", _none(), F.col("what"), _none(), _none(), F.col("n"))))
    )


@query(
    """
    with t as (select p_partkey as k, ['[file:name = ''x''] AND [a:b IN (1, 2)]', '[file:name = ''x'' AND', 'not a pattern', '[a:b.''c-d'' LIKE ''it\\''s''] WITHIN 5 SECONDS', ' ', '[domain-name:value = ''' || p_type || ''']'][p_partkey % 6 + 1] as p from part)
    select k as p_partkey, k % 6 in (0, 3, 5) as valid,
           case k % 6 when 0 then 'file: x' when 1 then 'file: x' when 5 then 'domain-name: ' || (select p_type from part q where q.p_partkey = k) when 3 then 'Indicator: a' else 'Indicator' end as name
    from t
    """
)
def q70_pattern_grammar(spark, sf_dir):
    pattern = _pick(
        "p_partkey", 6,
        [
            F.lit("[file:name = 'x'] AND [a:b IN (1, 2)]"), F.lit("[file:name = 'x' AND"), F.lit("not a pattern"), F.lit("[a:b.'c-d' LIKE 'it\\'s'] WITHIN 5 SECONDS"), F.lit(" "),
            _text("[domain-name:value = '", ("p_type",), "']"),
        ],
    )
    p = load(spark, sf_dir, "part").select("p_partkey", pattern.alias("pattern"))
    return p.select("p_partkey", graph.valid_pattern("pattern", F.lit("stix")).alias("valid"), text.indicator_name("pattern").alias("name"))


@query(
    f"""
    with w as (select doc_id, w, min(i) as i from (select doc_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z0-9-]{{3,}}')) as w, generate_subscripts(regexp_extract_all(lower(text), '[a-z][a-z0-9-]{{3,}}'), 1) as i from documents) group by 1, 2),
    r as (select *, row_number() over (partition by doc_id order by i) as n from w where w not in ({", ".join(f"'{x}'" for x in vocab.STOPWORDS)}))
    select d.doc_id, coalesce(string_agg(w, ' ' order by i), '') as keywords from documents d left join r on r.doc_id = d.doc_id and n <= 6 group by 1
    """
)
def q71_keywords(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", F.array_join(text.keywords(F.coalesce("text", F.lit(""))), " ").alias("keywords"))


@query(
    r"""
    with t as (select doc_id, coalesce(text, '') as t from documents)
    select doc_id, length(t) as n, md5(case when length(t) > 300 then substr(t, 1, 275) || chr(10) || chr(10) || '[truncated to the limit]'[1:23] else t end) as cut,
           md5(replace(replace(t, '|', '\|'), chr(10), ' ')) as cell, ['fast', 'slow', 'fast', 'mid'][doc_id % 4 + 1] as model,
           ['text/html', 'application/pdf'][doc_id % 2 + 1] as mime, (case when doc_id % 4 = 3 then 0.0 else (doc_id % 100) + 0.5 end)::double as seconds
    from t
    """
)
def q72_small_functions(spark, sf_dir):
    d = load(spark, sf_dir, "documents").withColumn("t", F.coalesce("text", F.lit("")))
    task = _pick("doc_id", 4, [F.lit("simple"), F.lit("complex"), F.lit("simple"), F.lit("other")])
    start = F.lit("2026-01-01 00:00:00").cast("timestamp")
    end = F.when(F.col("doc_id") % 4 == 3, start).otherwise(F.timestamp_micros(F.unix_micros(start) + (F.col("doc_id") % 100) * 1_000_000 + 500_000))
    kind = F.when(F.col("doc_id") % 2 == 0, " Text/HTML ; charset=utf-8").otherwise("application/PDF")
    return d.select(
        "doc_id", F.length("t").cast("bigint").alias("n"), F.md5(text.truncated("t", 300, "\n\n[truncated to the limit]"[:25]).cast("binary")).alias("cut"), F.md5(text.cell("t").cast("binary")).alias("cell"),
        scalar.model_of(task, "fast", "mid", "slow").alias("model"), text.mime(kind).alias("mime"), scalar.seconds_between(start, end).alias("seconds"),
    )


@query(
    r"""
    with t as (select doc_id, replace(text, chr(10), chr(10) || chr(10)) as t from documents where text is not null),
    r as (select doc_id, case when length(t) <= 2000 then t else list_reduce(string_split_regex(t, '\n[\s\x{A0}\x{85}\x1c-\x1f]*\n'), lambda a, p:
            case when length(p) > 2000 then a || chr(1) || array_to_string([substr(p, 1 + i * 2000, 2000) for i in range((length(p) + 1999) // 2000)], chr(1)) || chr(2)
                 when a = '' then p when right(a, 1) = chr(2) then a || chr(1) || p
                 when length(string_split(a, chr(1))[-1]) + 2 + length(p) <= 2000 then a || chr(10) || chr(10) || p else a || chr(1) || p end, '') end as r from t)
    select doc_id, md5(replace(ltrim(r, chr(1)), chr(2), '')) as chunks from r
    """
)
def q73_chunk_texts(spark, sf_dir):
    d = load(spark, sf_dir, "documents").where("text is not null")
    c = text.chunks(F.replace("text", F.lit("\n"), F.lit("\n\n")), 2000)
    return d.select("doc_id", F.md5(F.array_join(c, "\x01").cast("binary")).alias("chunks"))


# --- crawl ------------------------------------------------------------------------------------

_NOW = "2026-02-03 04:05:06"
_CRAWL = r"""
    d as (select doc_id as k, text, 'https://e.org/d' || doc_id as url from documents),
    o as (select k, url, text, case
        when k % 13 = 0 then 'fetch_failed' when k % 7 = 0 and text is not null then 'skipped_unchanged'
        when regexp_full_match(coalesce(text, ''), '[\s\x{A0}\x{85}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*') then case when text is null then 'fetch_failed' else 'extraction_failed' end
        when k % 10 < 5 then 'skipped_below_threshold' when k % 3 = 0 then 'no_objects' else 'extracted' end as kind from d)"""


def _crawl(spark, sf_dir, **more):
    d = load(spark, sf_dir, "documents")
    k = F.col("doc_id")
    url = _text("https://e.org/d", ("doc_id",))
    policy = F.when(k % 2 == 0, F.array(F.lit("p1"))).otherwise(F.array().cast("array<string>"))
    sources = d.select(url.alias("url"), F.lit("l").alias("label"), F.lit("simple").alias("task"), F.when(k % 4 == 0, 5).cast("int").alias("max_chars"), policy.alias("pir_ids"))
    fetched = d.select(
        url.alias("url"), F.when(k % 13 != 0, F.encode("text", "utf-8")).alias("content"), F.lit("text/plain").alias("content_type"), F.when(k % 13 == 0, "status 500").alias("error")
    )
    old = d.where("doc_id % 7 = 0").select(
        url.alias("url"), F.lit("2025-01-01T00:00:00.000Z").alias("first_seen"), F.lit("2025-01-01T00:00:00.000Z").alias("last_seen"), F.sha2(F.encode("text", "utf-8"), 256).alias("content_sha256"),
        _none().alias("bundle_path"), F.expr("cast(null as struct<decision:string,score:double,matched_pir_ids:array<string>,rationale:string,pir_set_hash:string>)").alias("relevance"),
        F.expr("cast(array() as array<struct<type:string,value:string,confidence:double,context_snippet:string>>)").alias("iocs"),
    )
    number = F.regexp_extract("url", "([0-9]+)$", 1).cast("int")
    seen = F.when(F.contains("prompt", F.lit('"p2"')), "both").otherwise("one")
    judge = lambda prompts: prompts.withColumn(
        "response", F.concat(F.lit('{"score": 0.'), number % 10, F.lit(', "matched_pir_ids": ["p1"], "rationale": "'), seen, F.lit('", "iocs": [{"type": "fqdn", "value": "v", "confidence": 0.5}]}'))
    )
    read = lambda prompts: prompts.withColumn(
        "response",
        F.when(F.regexp_extract("doc_id", "([0-9]+)$", 1).cast("int") % 3 == 0, '{"entities": []}').otherwise(
            F.concat(F.lit('{"entities": [{"local_id": "a", "type": "malware", "name": "'), F.col("task"), F.length("prompt"), F.lit('"}]}'))
        ),
    )
    pirs = spark.createDataFrame(
        [("h", 0, "p1", "d", ["t"], []), ("h", 1, "p2", "e", [], [])],
        "pir_set_hash string, pos int, pir_id string, description string, threat_actor_tags array<string>, prioritized_actors array<struct<name:string>>",
    )
    given = {"keep": kept, "gate_model": judge, "extract_model": read, "context": None, "pirs": pirs, **more}
    return api.crawl_batch(sources, fetched, old, pir_set_hash="h", now=F.lit(_NOW).cast("timestamp"), **given)


@query(
    f"""with {_CRAWL}, x as (select *, kind in ('extracted', 'no_objects', 'skipped_below_threshold') as touched, kind = 'extracted' as made, least(length(text), 5) as n from o)
    select url, 'l' as label, kind, case when touched then (k % 10) / 10.0::double end as relevance_score,
           case when k % 13 = 0 then 'status 500' when kind = 'fetch_failed' then 'not fetched' when kind = 'extraction_failed' then 'empty article text' end as error,
           case when k % 7 = 0 then '2025-01-01T00:00:00.000Z' when touched then '2026-02-03T04:05:06.000Z' end as first_seen,
           case when touched then case kind when 'extracted' then 'kept' when 'no_objects' then 'extraction_failed' else kind end end as decision,
           case when touched then case when k % 2 = 0 then 'one' else 'both' end end as rationale, (case when touched then 1 when k % 7 = 0 then 0 end)::integer as n_iocs,
           case when made then 'stix/bundle_e.org-d' || k || '.json' end as bundle_path, case when made then url end as source_url, case when made then '2026-02-03T04:05:06.000Z' end as collected_at,
           case when made then (k % 10) / 10.0::double end as score, case when made then 'extension-definition,malware' end as types, case when made then '{vocab.EXTENSION_ID}' end as declared,
           case when made and k % 4 = 0 then 'simple' || n end as name
    from x"""
)
def q74_crawl(spark, sf_dir):
    """Outcome, next state and bundle of every source."""
    done = _crawl(spark, sf_dir)
    s = done.state.select("url", "first_seen", F.col("relevance.decision").alias("decision"), F.col("relevance.rationale").alias("rationale"), F.size("iocs").alias("n_iocs"), "bundle_path")
    doc = F.from_json("bundle", "struct<objects:array<struct<type:string,name:string>>,extensions:map<string,struct<extension_type:string>>>")
    own = lambda name: F.get_json_object("bundle", f"$.{vocab.PROPERTY}{name}")
    clipped = F.regexp_extract("url", "([0-9]+)$", 1).cast("int") % 4 == 0
    b = done.bundles.select(
        "url", own("source_url").alias("source_url"), own("collected_at").alias("collected_at"), own("relevance_score").cast("double").alias("score"),
        F.array_join(F.array_distinct(F.transform(doc["objects"], lambda o: o["type"])), ",").alias("types"),
        F.array_join(F.map_keys(doc["extensions"]), ",").alias("declared"), F.when(clipped, F.element_at(doc["objects"], -1)["name"]).alias("name"),
    )
    return done.outcomes.select("url", "label", "kind", "relevance_score", "error").join(s, "url", "left").join(b, "url", "left")


@query("select 'https://e.org/d' || doc_id as url, 'extracted' as kind from documents")
def q77_dry_run(spark, sf_dir):
    return _crawl(spark, sf_dir, dry_run=True).outcomes.select("url", "kind")


@query(
    f"""with {_CRAWL}
    select kind, count(*) as n from (select case kind when 'skipped_below_threshold' then case when k % 3 = 0 then 'no_objects' else 'extracted' end else kind end as kind from o)
    where kind <> 'skipped_unchanged' group by 1"""
)
def q78_ungated_outcomes(spark, sf_dir):
    done = _crawl(spark, sf_dir, gate_model=None).outcomes
    return state.without_unchanged(done).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    select o_orderkey as doc_id, 's' || u.i as source_name, case when u.i = 0 then null else 'r' || ((o_orderkey + u.i) % 50) end as url,
           case when u.i = 0 then null when (o_orderkey + u.i) % 50 % 3 = 0 then 'cached' || ((o_orderkey + u.i) % 50) when (o_orderkey + u.i) % 50 % 3 = 1 then 'new' || ((o_orderkey + u.i) % 50) end as sha256
    from orders, (select unnest([0, 1, 2]) as i) u
    """
)
def q79_reference_hashes(spark, sf_dir):
    n = F.col("o_orderkey")
    ref = lambda i: F.struct(F.lit(f"s{i}").alias("source_name"), _none().alias("external_id"), (_none() if i == 0 else F.concat(F.lit("r"), (n + i) % 50)).alias("url"))
    nodes = load(spark, sf_dir, "orders").select(n.alias("doc_id"), F.lit("c").alias("canonical"), F.array(*map(ref, range(3))).alias("external_references"))
    r = spark.range(50)
    entry = F.concat(F.lit('{"sha256":"cached'), "id", F.lit('","fetched_at":"'), F.when(F.col("id") % 3 == 0, "2026-01-20T00:00:00+00:00").otherwise("2020-01-01"), F.lit('","status":"ok"}'))
    texts = r.select(F.concat(F.lit('{"r'), "id", F.lit('":'), entry, F.lit("}")).alias("value")).union(spark.createDataFrame([("broken {",)], "value string"))
    fetched = r.where("id % 3 = 1").select(F.concat(F.lit("r"), "id").alias("url"), F.concat(F.lit("new"), "id").alias("sha256"))
    done, _ = graph.hashed_references(nodes, documents.load_hash_cache(texts), fetched, F.lit("2026-02-01").cast("timestamp"))
    return done.select("doc_id", F.inline("external_references")).select("doc_id", "source_name", "url", F.col("hashes")["SHA-256"].alias("sha256"))


@query(
    """
    with e as (select event_type, count(*) as n, count(*) filter (user_id % 3 = 0) as w, count(*) filter (user_id % 6 = 0) as m from events group by 1)
    select event_type as source, n as entries, w as in_window, m as matched from e union all select null, sum(n)::bigint, sum(w)::bigint, sum(m)::bigint from e
    """
)
def q80_discovery_counters(spark, sf_dir):
    e = load(spark, sf_dir, "events").select(F.col("event_type").alias("source"), (F.col("user_id") % 3 == 0).alias("in_window"), "user_id")
    return discovery.counters(e, e.where("user_id % 6 = 0"))


@query(
    """
    select rpad(event_type, 40, ' ') || '  ' || rpad('' || event_id, 40, ' ') || '  ' || rpad('red', 40, ' ') || '  ' || rpad('', 40, ' ') as line from events
    """
)
def q81_match_lines(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    return sinks.match_table(e.select(F.col("event_type").alias("type"), F.col("event_id").alias("value"), F.lit("red").alias("tlp"), _none().alias("url")))


@query(
    """
    with c as (select o_orderkey as k, o_totalprice as p from orders order by p desc, k limit 30)
    select '1.0.0' as version, count(*)::integer as n, min(k)::varchar as least, max(k)::varchar as most from c
    """
)
def q82_candidate_envelope(spark, sf_dir):
    best = load(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(30)
    out = sinks.candidate_envelope(best.select(F.lit(0).alias("ord_out"), F.col("o_orderkey").alias("k")))
    doc = F.from_json("json", "struct<schema_version:string,candidates:array<struct<k:bigint>>>")
    keys = F.transform(doc["candidates"], lambda c: c["k"])
    return out.select(doc["schema_version"].alias("version"), F.size(keys).alias("n"), F.array_min(keys).cast("string").alias("least"), F.array_max(keys).cast("string").alias("most"))


@query(
    """
    select 'enabled' as what, s_name as name from supplier where s_suppkey % 3 <> 0
    union all select distinct 'high_value', trim(c_mktsegment) from customer where c_custkey % 2 = 0
    """
)
def q83_in_use(spark, sf_dir):
    s, c = load(spark, sf_dir, "supplier"), load(spark, sf_dir, "customer")
    catalog = s.select(F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 3 == 0, False).when(F.col("s_suppkey") % 3 == 1, True).alias("enabled"))
    marked = c.select(F.concat(F.lit(" "), "c_mktsegment").alias("name"), (F.col("c_custkey") % 2 == 0).alias("is_high_value_impersonation_target"))
    return documents.enabled(catalog).select(F.lit("enabled").alias("what"), "name").unionByName(gate.high_value_names(marked).select(F.lit("high_value").alias("what"), "name"))


@query(
    """
    select user_id as run_id, (max(event_id) - min(event_id))::double as seconds, count(*) as n from events group by 1
    """
)
def q84_run_durations(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    ends = e.groupBy(F.col("user_id").alias("run_id")).agg(F.min("event_id").alias("a"), F.max("event_id").alias("b"), F.count(F.lit(1)).alias("n"))
    rows = ends.select("run_id", F.expr("stack(2, 'run_started', a, 'run_finished', b) as (event, at)"))
    at = F.date_format(F.timestamp_seconds(F.col("at")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return metrics.durations(rows.select("run_id", "event", F.to_json(F.struct(at.alias("at"))).alias("payload"))).join(ends.select("run_id", "n"), "run_id")


@query(
    """
    select '### ' || p_partkey || chr(10) || '- description: ' || p_name || chr(10) || '- threat_actor_tags: ' || p_type || ', ' || p_brand || chr(10) || '- prioritized_asset_tags: a, z' as block from part
    """
)
def q85_requirement_blocks(spark, sf_dir):
    rule = lambda t: F.struct(F.lit(t).alias("tag"))
    pirs = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pos"), F.col("p_partkey").cast("string").alias("pir_id"), _none().alias("intelligence_level"), F.col("p_name").alias("description"),
        F.array("p_type", "p_brand").alias("threat_actor_tags"), F.array().cast("array<string>").alias("notable_groups"), F.lit(None).cast("array<string>").alias("collection_focus"),
        F.array(rule("z"), rule("a"), rule("z")).alias("asset_weight_rules"),
    )
    return pirs.select(documents.pir_lines().alias("block"))
