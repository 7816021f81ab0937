"""Validation, text and id queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions import scalar, text
from ..operators import graph, integrity
from ..session import load
from .registry import query

_DUP = """
    d as (
        select 'text' as kind, sha256(text) as key, count(*) as n from documents group by 2 having count(*) > 1
        union all select 'pair', l_orderkey || ',' || l_partkey, count(*) from lineitem group by 2 having count(*) > 1
    )"""


@query(f"with {_DUP} select * from d")
def q09_duplicate_keys(spark, sf_dir):
    docs = integrity.counted_duplicates(load(spark, sf_dir, "documents").select(scalar.sha256("text").alias("key")), ["key"])
    pairs = integrity.counted_duplicates(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])
    return docs.select(F.lit("text").alias("kind"), "key", "n").unionByName(
        pairs.select(F.lit("pair").alias("kind"), F.concat_ws(",", "l_orderkey", "l_partkey").alias("key"), "n")
    )


_REFS = """
    r as (
        select 'error' as severity, 'CUSTOMER_REF_NATION' as code, 'customer[' || c_custkey || ']' as location, 'nation ' || c_nationkey || ' does not resolve' as message
        from customer where c_nationkey not in (select n_nationkey from nation where n_nationkey < 20)
        union all select 'warning', 'SUPPLIER_REF_NATION', 'supplier[' || s_suppkey || ']', 'nation ' || s_nationkey || ' does not resolve'
        from supplier where s_nationkey not in (select n_nationkey from nation where n_nationkey < 20)
    )"""


def _ref_findings(spark, sf_dir):
    nations = load(spark, sf_dir, "nation").where("n_nationkey < 20")
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos"), F.col("c_nationkey").alias("nation"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pos"), F.col("s_nationkey").alias("nation"))
    return integrity.union(
        [
            integrity.dangling(c, "nation", nations, "n_nationkey", "CUSTOMER_REF_NATION", integrity.at("customer")),
            integrity.dangling(s, "nation", nations, "n_nationkey", "SUPPLIER_REF_NATION", integrity.at("supplier"), "warning"),
        ]
    )


@query(f"with {_REFS} select * from r")
def q10_ref_integrity(spark, sf_dir):
    return _ref_findings(spark, sf_dir)


_EDGE_SQL = """
    ends as (
        select l_orderkey * 10 + l_linenumber as pos, 'source_ref' as field, 'order--' || l_orderkey as ref from lineitem
        union all select l_orderkey * 10 + l_linenumber, 'target_ref', case when l_linenumber < 7 then 'part--' || l_partkey end from lineitem
    ), ids as (select 'order--' || o_orderkey as id from orders where o_totalprice > 50000 union select 'part--' || p_partkey from part where p_size <= 40),
    f as (
        select 'REL_REF_MISSING' as code, 'objects[' || pos || '].' || field as location from ends where ref is null
        union all select 'REL_REF_UNRESOLVED', 'objects[' || pos || '].' || field from ends where ref is not null and ref not in (select id from ids)
    )"""


def _edges(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    edges = li.select(
        F.lit("b").alias("bundle_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        F.concat(F.lit("order--"), "l_orderkey").alias("source_ref"),
        F.when(F.col("l_linenumber") < 7, F.concat(F.lit("part--"), "l_partkey")).alias("target_ref"),
    )
    o = load(spark, sf_dir, "orders").where("o_totalprice > 50000").select(F.lit("b").alias("bundle_id"), F.concat(F.lit("order--"), "o_orderkey").alias("id"))
    p = load(spark, sf_dir, "part").where("p_size <= 40").select(F.lit("b").alias("bundle_id"), F.concat(F.lit("part--"), "p_partkey").alias("id"))
    return o.unionByName(p), edges


@query(f"with {_EDGE_SQL} select code, location from f")
def q11_edge_refs(spark, sf_dir):
    return integrity.check_refs(*_edges(spark, sf_dir)).select("code", "location")


@query(
    f"""with {_DUP}, {_REFS}, {_EDGE_SQL}, fs as (
        select 'duplicates' as section, 'error' as severity from d union all select 'refs', severity from r union all select 'edges', 'error' from f
    ), sections(section) as (values ('duplicates'), ('edges'), ('none'), ('refs'))
    select section, count(*) filter (severity = 'error') as n_error, count(*) filter (severity = 'warning') as n_warning,
           count(*) filter (severity = 'info') as n_info, case when count(*) filter (severity = 'error') > 0 then 'FAIL' else 'PASS' end as verdict
    from sections left join fs using (section) group by rollup(section)"""
)
def q12_findings_rollup(spark, sf_dir):
    parts = {
        "duplicates": q09_duplicate_keys(spark, sf_dir).select(F.lit("error").alias("severity")),
        "refs": _ref_findings(spark, sf_dir).select("severity"),
        "edges": q11_edge_refs(spark, sf_dir).select(F.lit("error").alias("severity")),
    }
    found = integrity.union([df.withColumn("section", F.lit(k)) for k, df in parts.items()])
    sections = spark.createDataFrame([(k,) for k in ("duplicates", "edges", "none", "refs")], "section string")
    return integrity.totals(found, sections)


@query("select page_id, sha256(html) as sha256 from pages")
def q21_content_hash(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", scalar.sha256("html").alias("sha256"))


@query(
    """
    with h as (select p_partkey, sha1(unhex('a1b2c3d4e5f67890abcdef1234567890') || encode('tool' || chr(0) || lower(p_name))) as h from part)
    select p_partkey, 'tool--' || h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || ['8','9','a','b'][(('0x' || h[17:17])::integer % 4) + 1] || h[18:20] || '-' || h[21:32] as id from h
    """
)
def q22_uuid5_ids(spark, sf_dir):
    none = F.lit(None).cast("string")
    return load(spark, sf_dir, "part").select("p_partkey", scalar.entity_id(F.lit("tool"), F.col("p_name"), none, none).alias("id"))


@query(
    """
    select page_id,
           coalesce(nullif(substr(regexp_replace(regexp_replace(regexp_replace(url, '^https?://', ''), '[^A-Za-z0-9._-]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80), ''), 'bundle') as slug,
           lower(regexp_replace(trim(url), '/+$', '')) as url_key
    from pages
    """
)
def q23_slug_url(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", text.slug("url").alias("slug"), text.url_key("url").alias("url_key"))


@query(
    """
    select * from (select doc_id, case doc_id % 4
        when 0 then 'CVE-2024-' || (doc_id + 1000)
        when 1 then regexp_extract('https://example.org/?name=CVE-2023-' || (doc_id + 1000) || '&x=1', 'CVE-[0-9]{4}-[0-9]{4,}', 0)
        when 2 then 'CVE-2022-' || (doc_id + 1000) else nullif(regexp_extract(text, 'CVE-[0-9]{4}-[0-9]{4,}', 0), '') end as cve
    from documents) where cve is not null
    """
)
def q24_cve_extract(spark, sf_dir):
    d, n = load(spark, sf_dir, "documents"), F.col("doc_id") + 1000
    k = F.col("doc_id") % 4
    ref = F.struct(
        F.when(k == 3, "other").otherwise("CVE").alias("source_name"),
        F.when(k == 0, F.concat(F.lit(" CVE-2024-"), n)).otherwise("none").alias("external_id"),
        F.when(k == 1, F.concat(F.lit("https://example.org/?name=CVE-2023-"), n, F.lit("&x=1"))).alias("url"),
    )
    name = F.when(k == 2, F.concat(F.lit("CVE-2022-"), n)).otherwise(F.col("text"))
    return d.select("doc_id", text.cve_id(name, F.array(ref)).alias("cve")).where("cve is not null")


_PHRASES = ("Almost certain", "very likely", "HIGHLY unlikely", "improbable", "we assess it is probable", "no evidence", "50/50", "nothing", "low confidence, confirmed")


@query(
    f"""
    with t as (select doc_id, lower(text || ' ' || {list(_PHRASES)!r}[doc_id % 9 + 1]) as t from documents)
    select doc_id, (case
        when regexp_matches(t, 'almost certain|definitive|confirmed|with certainty') then 95
        when regexp_matches(t, 'very likely|highly probable|high confidence|very probable') then 85
        when regexp_matches(t, 'highly unlikely|very unlikely|highly improbable') then 15
        when regexp_matches(t, 'unlikely|improbable|low confidence') then 30
        when regexp_matches(t, 'likely|probable|moderate confidence') then 70
        when regexp_matches(t, 'no evidence|no indication|almost no chance|remote chance') then 5
        when regexp_matches(t, 'roughly even|we assess|even chance|50/50') then 50 end)::integer as confidence from t
    """
)
def q25_hedge_confidence(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    phrase = F.get(F.array(*map(F.lit, _PHRASES)), (F.col("doc_id") % 9).cast("int"))
    return d.select("doc_id", text.hedge_confidence(F.concat_ws(" ", "text", phrase)).alias("confidence"))


@query(
    r"""
    with t as (select doc_id, replace(text, chr(10), chr(10) || chr(10)) as t from documents),
    p as (select doc_id, t, [length(x) for x in string_split_regex(t, '\n[\s\x{A0}\x{85}]*\n')] as ls from t)
    select doc_id, case when length(t) <= 2000 then length(t) else list_sum(ls) end::bigint as chars, true as fits from p
    """
)
def q26_chunks(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select("doc_id", text.chunks(F.replace("text", F.lit("\n"), F.lit("\n\n")), 2000).alias("c"))
    # Without the joints that packing put between paragraphs; a text that fits is left as it is.
    exploded = d.select("doc_id", F.size("c").alias("n"), F.explode_outer("c").alias("c")).where("c is not null")
    body = F.when(F.col("n") == 1, F.length("c")).otherwise(F.length(F.replace("c", F.lit("\n\n"), F.lit(""))))
    return exploded.groupBy("doc_id").agg(F.sum(body.cast("bigint")).alias("chars"), F.bool_and(F.length("c") <= 2000).alias("fits"))


@query(
    r"""
    with t as (select doc_id, text || chr(10) || repeat('#', (doc_id % 4)::integer) || ' Head' || chr(10) || 'x' as t from documents)
    select doc_id, (case when instr(substr(t, 501), regexp_extract(substr(t, 501), '\n#{1,2} .+', 0)) > 0 and regexp_extract(substr(t, 501), '\n#{1,2} .+', 0) <> ''
        then 500 + instr(substr(t, 501), regexp_extract(substr(t, 501), '\n#{1,2} .+', 0)) else 0 end)::integer as start,
        length(case when length(t) > 300 then substr(t, 1, 300) || chr(10) || chr(10) || '[...truncated]' else t end)::integer as clipped
    from t
    """
)
def q27_article_start(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    t = F.concat("text", F.lit("\n"), F.repeat(F.lit("#"), (F.col("doc_id") % 4).cast("int")), F.lit(" Head\nx"))
    return d.select("doc_id", text.article_start(t).cast("int").alias("start"), F.length(text.clipped(t, 300)).alias("clipped"))


@query(
    """
    select relationship_type, source_type, target_type, count(*) as n from (
        select case l_linenumber % 2 when 0 then 'attributed-to' else 'impersonates' end as relationship_type,
               case l_returnflag when 'A' then 'campaign' when 'R' then 'threat-actor' else 'intrusion-set' end as source_type,
               case when l_linestatus = 'O' then 'threat-actor' else 'identity' end as target_type
        from lineitem)
    where not ((source_type = 'campaign' and relationship_type = 'attributed-to' and target_type in ('intrusion-set', 'threat-actor'))
        or (source_type = 'intrusion-set' and relationship_type = 'attributed-to' and target_type = 'threat-actor')
        or (source_type = 'threat-actor' and target_type in ('identity', 'x-identity-internal')))
    group by all
    """
)
def q41_attribution_matrix(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_returnflag") == "A", "campaign").when(F.col("l_returnflag") == "R", "threat-actor").otherwise("intrusion-set")
    target = F.when(F.col("l_linestatus") == "O", "threat-actor").otherwise("identity")
    edges = li.select(
        F.lit("b").alias("bundle_id"),
        F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey").alias("id"),
        F.when(F.col("l_linenumber") % 2 == 0, "attributed-to").otherwise("impersonates").alias("relationship_type"),
        F.concat(kind, F.lit("--"), "l_orderkey").alias("source_ref"),
        F.concat(target, F.lit("--p"), "l_partkey").alias("target_ref"),
    )
    # Parts are named nodes of their own; the types of orders follow from their ids.
    nodes = edges.select("bundle_id", F.col("target_ref").alias("id"), F.split_part("target_ref", F.lit("--"), F.lit(1)).alias("type")).distinct()
    found = integrity.check_attribution(nodes, edges, graph.triples(spark, vocab.ATTRIBUTION))
    parts = F.split("message", " ")
    return found.groupBy(parts[1].alias("relationship_type"), parts[0].alias("source_type"), parts[2].alias("target_type")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    select 'LINEITEM_SCHEMA' as code, 'lineitem[' || l_orderkey || '/' || l_linenumber || '].' || f as location from (
        select l_orderkey, l_linenumber, unnest(list_filter([case when l_discount > 0.09 then 'l_discount' end, case when l_quantity not between 1 and 49 then 'l_quantity' end,
            case when l_returnflag not in ('A', 'N') then 'l_returnflag' end], lambda x: x is not null)) as f from lineitem)
    """
)
def q42_field_rules(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    rules = [
        ("LINEITEM_SCHEMA", "l_discount", F.col("l_discount") > 0.09),
        ("LINEITEM_SCHEMA", "l_quantity", integrity.beyond("l_quantity", 1, 49)),
        ("LINEITEM_SCHEMA", "l_returnflag", integrity.not_in("l_returnflag", ("A", "N"))),
    ]
    where = F.concat(F.lit("lineitem["), "l_orderkey", F.lit("/"), "l_linenumber", F.lit("]"))
    return integrity.check_rules(li, rules, where).select("code", "location")


@query(
    """
    with p(field, types, format, required) as (values ('a', ['string'], null, true), ('b', ['integer'], null, true), ('c', ['string'], 'date', false), ('e', ['number'], null, true)),
    c(field, types, format, required) as (values ('a', ['string'], null, true), ('b', ['string'], null, false), ('c', ['string'], null, false), ('d', ['array'], null, false))
    select field, unnest(list_filter([
        case when c.types is null then 'missing_in_consumer' end, case when p.types is null then 'missing_in_producer' end,
        case when p.types is not null and c.types is not null and not list_has_any(p.types, c.types) then 'types_disjoint' end,
        case when p.types is not null and c.types is not null and p.format is distinct from c.format then 'format_differs' end,
        case when p.required <> c.required then 'required_differs' end], lambda x: x is not null)) as rule
    from p full join c using (field)
    """
)
def q37_schema_drift(spark, sf_dir):
    ddl = "field string, types array<string>, format string, required boolean, extra boolean"
    p = [("a", ["string"], None, True, None), ("b", ["integer"], None, True, None), ("c", ["string"], "date", False, None), ("e", ["number"], None, True, None)]
    c = [("a", ["string"], None, True, None), ("b", ["string"], None, False, None), ("c", ["string"], None, False, None), ("d", ["array"], None, False, None)]
    return integrity.schema_drift(spark.createDataFrame(p, ddl), spark.createDataFrame(c, ddl))
