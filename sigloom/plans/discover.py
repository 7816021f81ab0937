"""Search, discovery, resolution and merging over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar, text
from ..operators import discovery, extraction, gate, graph, relational, resolve
from ..session import load, load_ts
from .registry import QUERIES, query

WS = r"[\s\x{A0}\x{85}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _state(spark, sf_dir):
    """Events as state entries, one indicator each."""
    e = load(spark, sf_dir, "events")
    ioc = F.struct(F.col("event_type").alias("type"), F.get_json_object("props", "$.k").alias("value"))
    return e.select(F.col("event_id").alias("url"), F.concat(F.lit("b"), F.col("user_id") % 7).alias("bundle_path"), F.array(ioc).alias("iocs"))


def _region_tlp(spark, sf_dir):
    r = load(spark, sf_dir, "region")
    return r.select(F.concat(F.lit("b"), "r_regionkey").alias("bundle_path"), scalar.level_of(F.col("r_regionkey") % 4).alias("tlp"))


@query(
    """
    select e.event_id as url, e.event_type as type, json_extract_string(e.props, '$.k') as value,
           coalesce(['clear', 'green', 'amber', 'red'][r.r_regionkey % 4 + 1], 'clear') as tlp
    from events e left join region r on r.r_regionkey = e.user_id % 7
    where lower(trim(json_extract_string(e.props, '$.k'))) = '42'
      and coalesce(r.r_regionkey % 4, 0) <= 2
    """
)
def q01_ioc_search(spark, sf_dir):
    index = _state(spark, sf_dir).select("url", "bundle_path", F.inline("iocs"))
    return gate.search(index, _region_tlp(spark, sf_dir), " 42 ", "amber").select("url", "type", "value", "tlp")


TERMS = [
    ("p1", "licensed under", "actor", 0.5),
    ("p1", "the_tion", "threat_actor_tag", 0.3),
    ("p1", "thand", "collection_focus", 0.2),
    ("p2", "thand", "actor", 0.5),
    ("p2", "heit", "asset_tag", 0.1),
    ("p2", "cc by-nc", "asset_tag", 0.1),
    ("p3", "eaux que", "description", 0.1),
    ("p3", "token", "actor_alias", 0.5),
]
_TERM_ROWS = ", ".join(f"('{p}', '{t}', {w})" for p, t, _, w in TERMS)
_MATCH = f"""
    with terms(pir_id, term, weight) as (values {_TERM_ROWS}),
    docs as (
        select doc_id, source, substr(text, 1, 80) as title, regexp_replace(lower(text), '(_|{WS})+', ' ', 'g') as h,
               regexp_replace(lower(substr(text, 1, 80)), '(_|{WS})+', ' ', 'g') as t,
               timestamp '2026-01-01' + to_days((doc_id % 60)::integer) as published
        from documents
    ), m as (
        select d.*, pir_id, term, weight::double as weight,
               contains(t, replace(term, '_', ' ')) or contains(replace(t, '-', ' '), replace(replace(term, '_', ' '), '-', ' ')) as in_title
        from docs d join terms
          on contains(h, replace(term, '_', ' ')) or contains(replace(h, '-', ' '), replace(replace(term, '_', ' '), '-', ' '))
    )"""
_SCORED = (
    _MATCH
    + """, s as (
        select doc_id, source, any_value(title) as title, any_value(published) as published,
               round(least(1.0, sum(weight + case when in_title then 0.2 else 0 end)
                   + 0.1 * greatest(0, least(1, (epoch_us(any_value(published)) - epoch_us(timestamp '2026-01-01'))::double
                   / (epoch_us(timestamp '2026-02-28 23:59:59.999999') - epoch_us(timestamp '2026-01-01'))))), 3) as score,
               list_sort(list(distinct pir_id)) as pirs, list_sort(list(distinct term)) as terms
        from m where published <= timestamp '2026-02-28 23:59:59.999999' group by doc_id, source
    )"""
)


def _terms(spark):
    return spark.createDataFrame(TERMS, "pir_id string, term string, category string, weight double")


def _entries(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    published = F.lit("2026-01-01").cast("timestamp") + F.make_interval(days=(F.col("doc_id") % 60).cast("int"))
    return d.select("doc_id", "source", F.col("text").alias("body"), F.substring("text", 1, 80).alias("title"), published.alias("published"))


@query(_MATCH + " select doc_id, pir_id, term, in_title from m")
def q02_term_match(spark, sf_dir):
    return discovery.match_terms(_entries(spark, sf_dir), _terms(spark)).select("doc_id", "pir_id", "term", "in_title")




def _scored(spark, sf_dir):
    start, end = F.lit("2026-01-01"), F.lit("2026-02-28")
    entries = _entries(spark, sf_dir).where(discovery.in_window("published", start, end))
    return discovery.score(discovery.match_terms(entries, _terms(spark)).drop("body"), ["doc_id", "source", "title"], "published", start, end)


@query(_SCORED + " select doc_id, score, array_to_string(pirs, ',') as matched_pir_ids, array_to_string(terms, ',') as matched_terms from s")
def q03_candidate_score(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("doc_id", "score", F.array_join("matched_pir_ids", ",").alias("matched_pir_ids"), F.array_join("matched_terms", ",").alias("matched_terms"))


_MERGED = (
    _SCORED
    + """, merged as (
        select lower(source) as url_key, max(score) as score, arg_max(doc_id, score * 1000000000000 - doc_id) as best_id,
               min(doc_id) as ord, list_sort(list_distinct(flatten(list(pirs)))) as pirs, list_sort(list_distinct(flatten(list(terms)))) as terms
        from s group by 1
    )"""
)


def _merged(spark, sf_dir):
    s = _scored(spark, sf_dir).withColumns({"best_id": F.col("doc_id"), "ord": F.col("doc_id"), "published_at": F.col("published")})
    return discovery.merge(s, text.url_key(F.concat("source", F.lit("/"))), ["best_id", "title", "published_at"], "ord")


@query(_MERGED + " select url_key, score, best_id, array_to_string(pirs, ',') as matched_pir_ids, array_to_string(terms, ',') as matched_terms from merged")
def q04_candidate_merge(spark, sf_dir):
    m = _merged(spark, sf_dir)
    return m.select("url_key", "score", "best_id", F.array_join("matched_pir_ids", ",").alias("matched_pir_ids"), F.array_join("matched_terms", ",").alias("matched_terms"))


@query(
    _MERGED
    + """, ranked as (
        select m.url_key, m.score, 0 as bucket, d.published as p, d.title as t, m.ord from merged m join docs d on d.doc_id = m.best_id
        union all
        select r.url_key, 0.0, 1, r.p, r.t, r.ord from (
            select lower(source) || '/' || (doc_id % 3) as url_key, arg_min(published, doc_id) as p, arg_min(title, doc_id) as t, min(doc_id) as ord
            from docs group by 1
        ) r anti join merged using (url_key)
    )
    select url_key, score, bucket from ranked order by bucket, score desc, p desc, t desc, ord limit 40
    """
)
def q05_topk_fallback(spark, sf_dir):
    e = _entries(spark, sf_dir).drop("body").withColumn("url_key", F.concat(F.lower("source"), F.lit("/"), F.col("doc_id") % 3))
    first = e.groupBy("url_key").agg(
        F.min_by("published", "doc_id").alias("published_at"), F.min_by("title", "doc_id").alias("title"), F.min("doc_id").alias("ord")
    )
    recent = first.withColumn("score", F.lit(0.0))
    return discovery.rank(_merged(spark, sf_dir), 40, recent).select("url_key", "score", "bucket")


@query(
    """
    with branches as (
        select p_brand as pir_id, p_name as raw, 0.5 as weight, 0 as prio, p_partkey as pos from part
        union all select p_brand, p_type, 0.3, 1, p_partkey from part
        union all select p_brand, p_type || '_' || p_size, 0.1, 4, p_partkey from part
    ), t as (
        select pir_id, weight, prio, pos, trim(regexp_replace(lower(raw), '[_\\s]+', ' ', 'g'), ' -_.,;:()[]{}') as term from branches
    ), once as (
        select *, row_number() over (partition by pir_id, term order by prio, pos) as n
        from t where length(term) between 3 and 80 and term not in ('and', 'the', 'with', 'this', 'that', 'from', 'into', 'also', 'report', 'risk', 'target')
    ), kept as (select *, row_number() over (partition by pir_id order by prio, pos) as k from once where n = 1)
    select pir_id, term, weight::double as weight from kept where k <= 80
    """
)
def q06_term_build(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    rows = F.array(
        F.struct(F.col("p_name").alias("raw"), F.lit(0.5).alias("weight"), F.lit(0).alias("prio")),
        F.struct(F.col("p_type").alias("raw"), F.lit(0.3).alias("weight"), F.lit(1).alias("prio")),
        F.struct(F.concat_ws("_", "p_type", "p_size").alias("raw"), F.lit(0.1).alias("weight"), F.lit(4).alias("prio")),
    )
    branches = p.select(F.col("p_brand").alias("pir_id"), F.col("p_partkey").alias("pos"), F.inline(rows)).withColumn("category", F.lit(""))
    return discovery.build_terms(branches).drop("category")


_MARKS = """
    marks as (
        select l_orderkey, max(greatest(case l_returnflag when 'R' then 3 when 'A' then 2 else 0 end, case l_linestatus when 'F' then 1 else 0 end)) as r
        from lineitem group by 1
    )"""
_LEVEL = "['clear', 'green', 'amber', 'red'][r + 1]"


def _order_tlp(spark, sf_dir):
    mark = {"R": "5e57c739-391a-4eb3-b6be-7d15ca92d5ed", "A": "f88d31f6-486f-44da-b317-01333bde0b82", "F": "bab4a63c-aed9-4cf5-a766-dfca5abac2bb"}
    ids = F.create_map(*(F.lit(x) for k, v in mark.items() for x in (k, f"marking-definition--{v}")))
    li = load(spark, sf_dir, "lineitem")
    refs = li.select("l_orderkey", F.explode(F.array("l_returnflag", "l_linestatus")).alias("flag")).select("l_orderkey", ids[F.col("flag")].alias("marking_ref"))
    return gate.bundle_tlp(refs, "l_orderkey")


@query(f"with {_MARKS} select l_orderkey, {_LEVEL} as tlp from marks")
def q07_tlp_max(spark, sf_dir):
    return _order_tlp(spark, sf_dir)


@query(
    f"""with {_MARKS} select o_orderkey, {_LEVEL.replace('r +', 'coalesce(r, 0) +')} as tlp
    from orders left join marks on o_orderkey = l_orderkey where coalesce(r, 0) <= 2"""
)
def q08_tlp_visible(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey")
    t = o.join(_order_tlp(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("tlp", F.coalesce("tlp", F.lit("clear")))
    return t.where(scalar.rank_of("tlp") <= scalar.rank_of(F.lit("amber"))).select("o_orderkey", "tlp")


_TIERS = """
    best as (select ref, min(tier) as tier from hits group by 1)
    select h.ref as reference, any_value(h.id) as id, h.tier::integer as tier, ([80, 50, 30][h.tier])::integer as confidence
    from hits h join best b on h.ref = b.ref and h.tier = b.tier group by h.ref, h.tier having count(*) = 1"""


@query(
    """
    with a as (select n_nationkey as id, 'site ' || lower(n_name) as name, 'zone' || n_regionkey as tag from nation
               union all select 100 + r_regionkey, r_name, 'area' || r_regionkey from region),
    refs as (
        select distinct lower(r) as r, r as ref from (
            select p_name as r from part union all select p_type from part union all select 'Site NATION_' || (p_size % 40) from part
            union all select 'the nation_' || (p_size % 9) || ' host' from part union all select r_name from region
            union all select 'AREA' || (p_size % 7) from part union all select 'zone' || (p_size % 7) from part union all select 'site nation_7' || 'x' from part))
    , hits as (
        select ref, id, 1 as tier from refs, a where r = lower(name)
        union all select ref, id, 2 from refs, a where r <> lower(name) and ((contains(lower(name), r) and length(r) >= 4) or (contains(r, lower(name)) and length(name) >= 4))
        union all select ref, id, 3 from refs, a where r = tag
    ),"""
    + _TIERS
)
def q13_tier_resolve(spark, sf_dir):
    n, r, p = (load(spark, sf_dir, t) for t in ("nation", "region", "part"))
    assets = n.select(F.col("n_nationkey").alias("id"), F.concat(F.lit("site "), F.lower("n_name")).alias("name"), F.array(F.concat(F.lit("zone"), "n_regionkey")).alias("tags"))
    assets = assets.unionByName(r.select((F.col("r_regionkey") + 100).alias("id"), F.col("r_name").alias("name"), F.array(F.concat(F.lit("area"), "r_regionkey")).alias("tags")))
    size = F.col("p_size")
    made = F.array(
        F.col("p_name"),
        F.col("p_type"),
        F.concat(F.lit("Site NATION_"), size % 40),
        F.concat(F.lit("the nation_"), size % 9, F.lit(" host")),
        F.concat(F.lit("AREA"), size % 7),
        F.concat(F.lit("zone"), size % 7),
        F.lit("site nation_7x"),
    )
    refs = p.select(F.explode(made).alias("reference")).distinct().union(r.select("r_name"))
    return resolve.resolve_assets(refs, assets)


@query(
    """
    with a as (select s_suppkey as id, s_name as name, lower(n_name) as role from supplier join nation on n_nationkey = s_nationkey),
    refs as (select distinct lower(r) as r, r as ref from (select s_name as r from supplier union all select n_name from nation union all select 'about ' || s_name from supplier)),
    hits as (
        select ref, id, 1 as tier from refs, a where r = lower(name)
        union all select ref, id, 2 from refs, a where r <> lower(name) and ((contains(lower(name), r) and length(r) >= 4) or (contains(r, lower(name)) and length(name) >= 4))
        union all select ref, id, 3 from refs, a where contains(role, r)
    ),"""
    + _TIERS
)
def q14_tier_resolve_list(spark, sf_dir):
    s, n = load(spark, sf_dir, "supplier"), load(spark, sf_dir, "nation")
    own = s.join(n, F.col("n_nationkey") == F.col("s_nationkey"))
    ids = own.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.array("n_name").alias("roles"), F.array().cast("array<string>").alias("sectors"))
    refs = s.select(F.col("s_name").alias("reference")).union(n.select("n_name")).union(s.select(F.concat(F.lit("about "), "s_name")))
    return resolve.resolve_identities(refs, ids)


@query(
    """
    select c_custkey, array_to_string([x for x in ['base', case when r_regionkey <> 3 then 'n' || (n_nationkey % 4) end, case when r_regionkey <> 3 then 'base2' end, 'r' || r_regionkey] if x is not null], ',') as labels,
           (case when r_regionkey <> 3 then 3 else 1 end)::integer as n_added
    from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
    """
)
def q15_taxonomy_enrich(spark, sf_dir):
    c, n, r = (load(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    tags = n.where("n_regionkey <> 3").select(
        text.normal_name("n_name").alias("group_norm"), F.posexplode(F.array(F.concat(F.lit("n"), F.col("n_nationkey") % 4), F.lit("base"), F.lit("base2"))).alias("ord", "tag")
    )
    tags = tags.unionByName(r.select(text.normal_name("r_name").alias("group_norm"), F.lit(9).alias("ord"), F.concat(F.lit("r"), "r_regionkey").alias("tag")))
    actors = (
        c.join(n, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(r, F.col("r_regionkey") == F.col("n_regionkey"))
        .select("c_custkey", F.concat(F.lit(" "), F.lower("n_name")).alias("name"), F.array("r_name").alias("aliases"), F.array(F.lit("base")).alias("labels"))
    )
    done = graph.enrich(actors, graph.index_tags(tags), "c_custkey")
    return done.select("c_custkey", F.array_join("labels", ",").alias("labels"), "n_added")


_ENTITIES = """
    e as (
        select conv_id as doc_id, turn as ord, 'c0_' || turn as alias, case role when 'user' then 'malware' else 'tool' end as type,
               lower(regexp_extract(text, '[^\\x20\\x09-\\x0D]+', 0)) as name, 'l' || (turn % 3) as l1, 'l' || (length(text) % 2) as l2,
               case when turn % 2 = 1 then 'd' || turn end as description
        from conversations
    ), keyed as (
        select *, coalesce('k:' || nullif(name, ''), 'a:' || alias) as k, min(ord) over w as first from e
        window w as (partition by doc_id, type, coalesce('k:' || nullif(name, ''), 'a:' || alias))
    )"""


def _entity_rows(spark, sf_dir):
    c = load(spark, sf_dir, "conversations")
    name = F.lower(F.regexp_extract("text", r"[^\x20\x09-\x0D]+", 0))
    labels = F.array(F.concat(F.lit("l"), F.col("turn") % 3), F.concat(F.lit("l"), F.length("text") % 2))
    return c.select(
        F.col("conv_id").alias("doc_id"),
        F.lit(0).alias("chunk"),
        F.col("turn").alias("ord"),
        F.concat(F.lit("c0_"), F.col("turn").cast("string")).alias("alias"),
        F.when(F.col("role") == "user", "malware").otherwise("tool").alias("type"),
        name.alias("name"),
        F.lit(None).cast("string").alias("pattern"),
        F.when(F.col("turn") % 2 == 1, F.concat(F.lit("d"), "turn")).alias("description"),
        labels.alias("labels"),
    )


@query(
    f"""with {_ENTITIES}, l as (
        select doc_id, type, k, u.v as v, min(u.p) as p from (
            select doc_id, type, k, unnest([{{'v': l1, 'p': ord * 2}}, {{'v': l2, 'p': ord * 2 + 1}}]) as u from keyed) group by 1, 2, 3, 4
    ), ls as (select doc_id, type, k, string_agg(v, ',' order by p) as labels from l group by 1, 2, 3)
    select x.doc_id, x.type, arg_min(alias, ord) as canonical, arg_min(name, ord) as name,
           arg_min(description, ord) filter (where description is not null) as description, any_value(labels) as labels, count(*) as n_merged
    from keyed x join ls using (doc_id, type, k) group by x.doc_id, x.type, x.k"""
)
def q16_entity_merge(spark, sf_dir):
    merged, _ = extraction.merge_entities(_entity_rows(spark, sf_dir), ["name", "description"], ["labels"])
    return merged.select("doc_id", "type", "canonical", "name", "description", F.array_join("labels", ",").alias("labels"), "n_merged")


@query(
    """
    select l_orderkey, l_suppkey, l_linenumber, l_partkey, l_quantity from (
        select *, row_number() over (partition by l_orderkey, l_suppkey order by l_linenumber, l_partkey, l_quantity, l_extendedprice) as n from lineitem)
    where n = 1
    """
)
def q17_first_wins(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    once = relational.first_of(li, ["l_orderkey", "l_suppkey"], "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return once.select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    f"""with {_ENTITIES}, canon as (select doc_id, alias, 'c0_' || first as canonical from keyed),
    rels as (select conv_id as doc_id, turn as ord, 'c0_' || turn as source, 'c0_' || (turn + 1) as target, case when turn % 2 = 0 then 'uses' else 'targets' end as rt from conversations),
    j as (select r.doc_id, r.ord, s.canonical as source, t.canonical as target, rt from rels r join canon s on s.doc_id = r.doc_id and s.alias = r.source
          join canon t on t.doc_id = r.doc_id and t.alias = r.target)
    select doc_id, source, target, rt as relationship_type, min(ord) as ord from j group by 1, 2, 3, 4"""
)
def q18_alias_remap(spark, sf_dir):
    e = _entity_rows(spark, sf_dir)
    _, aliases = extraction.merge_entities(e, ["name"], [])
    rels = e.select(
        "doc_id",
        "chunk",
        "ord",
        F.col("alias").alias("source"),
        F.concat(F.lit("c0_"), (F.col("ord") + 1).cast("string")).alias("target"),
        F.when(F.col("ord") % 2 == 0, "uses").otherwise("targets").alias("relationship_type"),
    )
    return extraction.merge_relationships(rels, aliases).select("doc_id", "source", "target", "relationship_type", "ord")


@query(
    """
    select l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus from lineitem
    where (l_returnflag, l_linestatus, month(l_shipdate) % 2) in (('A', 'F', 0), ('R', 'F', 1), ('N', 'O', 0))
    """
)
def q19_triple_filter(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").withColumn("parity", F.month("l_shipdate") % 2)
    allowed = graph.triples(spark, [("A", "F", "0"), ("R", "F", "1"), ("N", "O", "0")]).select(
        F.col("source_type").alias("l_returnflag"), F.col("relationship_type").alias("l_linestatus"), F.col("target_type").cast("int").alias("parity")
    )
    kept = li.join(F.broadcast(allowed), ["l_returnflag", "l_linestatus", "parity"], "left_semi")  # three literal rows
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")


@query(
    """
    select p_partkey, case when p_type in ('ECONOMY', 'PROMO', 'MEDIUM') then p_type end as tool_types,
           array_to_string(list_distinct([]::varchar[]) || case when p_type in ('ECONOMY', 'PROMO', 'MEDIUM') then ['base'] else ['base', p_type] end, ',') as labels
    from part
    """
)
def q20_vocab_demote(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    words = ("ECONOMY", "MEDIUM", "PROMO")
    kinds = F.array("p_type")
    return p.select(
        "p_partkey",
        F.array_join(text.inside(kinds, words), ",").alias("tool_types"),
        F.array_join(text.with_labels(F.array(F.lit("base")), text.outside(kinds, words)), ",").alias("labels"),
    )


__all__ = ["QUERIES", "load_ts"]
