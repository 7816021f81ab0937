"""The gate, incremental state, feeds, metrics and graphs over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import vocab
from ..functions import jsontext, scalar
from ..operators import gate, graph, metrics, relational, state
from ..session import load, load_ts, shared_dir
from ..sources import feeds
from ..streaming import crawl as stream
from .registry import query

_VERDICT = """
    v as (
        select doc_id, case when failed then null else least(1.0, greatest(0.0, raw)) end as s, failed from (
            select doc_id, raw, doc_id % 11 = 0 or (doc_id % 3 = 0 and raw < 0) as failed
            from (select doc_id, quality * 0.7 - toxic * 0.5 + (doc_id % 10) * 0.05 as raw from labels))
    )"""


@query(f"with {_VERDICT} select doc_id, round(coalesce(s, 0.0), 6) as score, failed from v where failed or s >= 0.5")
def q28_gate(spark, sf_dir):
    raw = F.round(F.col("quality") * 0.7 - F.col("toxic") * 0.5 + (F.col("doc_id") % 10) * 0.05, 9)
    good = F.concat(F.lit('Sure:\n```json\n{"score": "'), raw.cast("string"), F.lit('", "matched_pir_ids": ["p1"], "rationale": "x"}\n```'))
    cut = F.concat(F.lit('{"score": '), raw.cast("string"), F.lit(', "matched_pir_ids": ["p1", "p2"'))
    response = F.when(F.col("doc_id") % 11 == 0, "no answer").when(F.col("doc_id") % 3 == 0, cut).otherwise(good)
    v = load(spark, sf_dir, "labels").select("doc_id", gate.verdict(response).alias("v"))
    kept = v.where(gate.keeps(F.col("v.score"), F.col("v.failed"), 0.5))
    return kept.select("doc_id", F.round("v.score", 6).alias("score"), F.col("v.failed").alias("failed"))


@query(
    """
    select doc_id, round(case when contains(lower(text), 'licensed under') or contains(lower(text), 'thand') then least(1.0, 0.3 + (doc_id % 10) * 0.07 + 0.2) else 0.3 + (doc_id % 10) * 0.07 end, 6) as score
    from documents
    """
)
def q29_boost(spark, sf_dir):
    base = F.lit(0.3) + (F.col("doc_id") % 10) * 0.07
    d = load(spark, sf_dir, "documents")
    return d.select("doc_id", F.round(gate.boosted(base, F.lit(False), F.col("text"), ["Licensed under", " THAND "]), 6).alias("score"))


# Every document has an entry in the old state and a fetched page; some of either have no counterpart.
_PREV = """prev as (select case when doc_id % 2 = 0 then doc_id::varchar else 'old' || doc_id end as url,
        sha256(case when doc_id % 5 = 0 then text || 'old' else text end) as sha, case when doc_id % 7 = 0 then 'old' else 'h1' end as pir from documents),
    new as (select case when doc_id % 3 <> 1 then doc_id::varchar else 'new' || doc_id end as url, sha256(text) as sha from documents)"""


def _previous(spark, sf_dir):
    d, i = load(spark, sf_dir, "documents"), F.col("doc_id")
    body = F.when(i % 5 == 0, F.concat("text", F.lit("old"))).otherwise(F.col("text"))
    relevance = F.from_json(F.concat(F.lit('{"decision":"kept","score":0.5,"pir_set_hash":"'), F.when(i % 7 == 0, "old").otherwise("h1"), F.lit('"}')), "decision string, score double, matched_pir_ids array<string>, rationale string, pir_set_hash string")
    return d.select(
        F.concat(F.when(i % 2 == 0, "").otherwise("old"), i).alias("url"),
        F.lit("2025-01-01T00:00:00.000Z").alias("first_seen"),
        F.lit("2025-06-01T00:00:00.000Z").alias("last_seen"),
        scalar.sha256(body).alias("content_sha256"),
        F.lit(None).cast("string").alias("bundle_path"),
        relevance.alias("relevance"),
        F.expr("cast(array() as array<struct<type:string,value:string,confidence:double,context_snippet:string>>)").alias("iocs"),
    )


def _fetched(spark, sf_dir):
    i = F.col("doc_id")
    return load(spark, sf_dir, "documents").select(F.concat(F.when(i % 3 != 1, "").otherwise("new"), i).alias("url"), scalar.sha256("text").alias("content_sha256"))


@query(f"with {_PREV} select n.url, coalesce(p.sha = n.sha and p.pir = 'h1', false) as unchanged from new n left join prev p using (url)")
def q30_unchanged_skip(spark, sf_dir):
    return state.changed(_fetched(spark, sf_dir), _previous(spark, sf_dir), "h1", recheck=True).select("url", "unchanged")


@query(
    f"""with {_PREV}
    select coalesce(p.url, n.url) as url, case when p.url is not null then '2025-01-01T00:00:00.000Z' else '2026-02-03T04:05:06.000Z' end as first_seen,
           case when n.url is not null then '2026-02-03T04:05:06.000Z' else '2025-06-01T00:00:00.000Z' end as last_seen, coalesce(n.sha, p.sha) as content_sha256
    from prev p full join new n on p.url = n.url"""
)
def q31_state_upsert(spark, sf_dir):
    old = _previous(spark, sf_dir)
    new = _fetched(spark, sf_dir).join(old.select("url", "bundle_path", "relevance", "iocs").limit(0), "url", "left")
    now = F.lit("2026-02-03 04:05:06").cast("timestamp")
    return state.upsert(old, new, now).select("url", "first_seen", "last_seen", "content_sha256")


@query(
    """
    select event_type, event_id from (
        select event_type, event_id, row_number() over (partition by event_type order by event_id) as n from events
        where user_id % 13 = 0 or ts >= timestamp '2024-02-01' - to_days(20))
    where n <= 50
    """
)
def q32_age_cap(spark, sf_dir):
    e = load_ts(spark, sf_dir, "events")
    published = F.when(F.col("user_id") % 13 != 0, F.col("ts"))
    found = e.select(F.col("event_type").alias("feed_url"), F.col("event_id").alias("pos"), published.alias("published_at"))
    kept = feeds.recent(found, F.lit("2024-02-01").cast("timestamp"), 20, 50)
    return kept.select(F.col("feed_url").alias("event_type"), F.col("pos").alias("event_id"))


_FOLDED = """
    f as (
        select user_id as run_id, arg_max((props->>'$.k')::double, event_id) filter (event_type = 'view') as input_chars,
               count(*) filter (event_type = 'click') as llm_calls, coalesce(sum((props->>'$.k')::double) filter (event_type = 'click'), 0) as llm_output_chars,
               max((props->>'$.k')::double) filter (event_type = 'purchase') as largest, coalesce(bool_or(event_type = 'error'), false) as failed
        from events group by 1
    )"""
_FOLDS = (
    ("input_chars", "view", "k", "last"),
    ("llm_calls", "click", None, "count"),
    ("llm_output_chars", "click", "k", "sum"),
    ("largest", "purchase", "k", "max"),
    ("failed", "error", None, "any"),
)


@query(f"with {_FOLDED} select * from f")
def q33_event_fold(spark, sf_dir):
    e = load(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), "event_id", "event_type", "props")
    return metrics.fold(e, _FOLDS, "run_id", "event_id", "event_type", "props")


@query("select kind, count(o_orderstatus) as n from (values ('F'), ('O'), ('P'), ('X'), ('Y')) k(kind) left join orders on kind = o_orderstatus group by kind")
def q34_outcome_hist(spark, sf_dir):
    return state.outcomes(load(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "kind"), ["F", "O", "P", "X", "Y"])


@query(f"with {_FOLDED} select count(*) as runs, min(run_id) as started_at, sum(llm_calls)::bigint as llm_calls, sum(llm_output_chars) as llm_output_chars from f")
def q35_batch_totals(spark, sf_dir):
    return metrics.batch_totals(q33_event_fold(spark, sf_dir), ["llm_calls", "llm_output_chars"], "run_id")


@query(
    """
    with c as (select case when page_id % 3 = 0 then url else 'gone/' || url end as url, min(sha256(html)) as sha, min(page_id) as p from pages group by 1),
    cache as (select url, sha, case p % 4 when 0 then '2026-01-20T00:00:00.000Z' when 1 then '2025-01-01T00:00:00.000Z' when 2 then 'bad' else '2026-01-31T00:00:00.000Z' end as fetched from c)
    select page_id, case when try_cast(fetched as timestamp) >= timestamp '2026-02-01' - to_days(30) then sha when page_id % 2 = 0 or exists (select 1 from pages q where q.url = p.url and q.page_id % 2 = 0) then 'fetched' end as sha256
    from pages p left join cache using (url)
    """
)
def q36_ref_hash_cache(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    p = F.col("p") % 4
    at = F.when(p == 0, "2026-01-20T00:00:00.000Z").when(p == 1, "2025-01-01T00:00:00.000Z").when(p == 2, "bad").otherwise("2026-01-31T00:00:00.000Z")
    at_url = lambda hit, other: F.when(hit, F.col("url")).otherwise(F.concat(F.lit(other), "url")).alias("url")
    cache = (
        pages.groupBy(at_url(F.col("page_id") % 3 == 0, "gone/"))
        .agg(F.min(scalar.sha256("html")).alias("sha256"), F.min("page_id").alias("p"))
        .select("url", "sha256", at.alias("fetched_at"), F.lit("ok").alias("status"))
    )
    fetched = pages.select(at_url(F.col("page_id") % 2 == 0, "other/"), F.lit("fetched").alias("sha256")).distinct()
    refs, _ = state.with_hashes(pages.select("page_id", "url"), cache, fetched, F.lit("2026-02-01").cast("timestamp"), 30)
    return refs.select("page_id", "sha256")


@query(
    """
    with u as (select s_suppkey, s_nationkey, s_name from supplier),
    e as (select s_suppkey, n_nationkey as asset_id from u join nation on n_nationkey = s_nationkey)
    select 'edge' as part, count(*) as n, count(distinct s_suppkey) as sources, count(distinct asset_id) as targets from e
    union all select 'node', count(distinct asset_id), 0, count(distinct asset_id) from e
    """
)
def q38_graph_edges(spark, sf_dir):
    s, n = load(spark, sf_dir, "supplier"), load(spark, sf_dir, "nation")
    nodes = s.select(
        F.lit(1).alias("doc_id"),
        F.col("s_name").alias("canonical"),
        F.lit("identity").alias("type"),
        scalar.entity_id(F.lit("identity"), F.col("s_name"), F.lit(None).cast("string"), F.lit(None).cast("string"), scalar.uuid5(vocab.NS_ENTITY, "s_name")).alias("id"),
    )
    edges = s.select(
        F.lit(1).alias("doc_id"), F.col("s_name").alias("source"), F.concat(F.lit("NATION_"), "s_nationkey").alias("asset_reference"), F.lit(None).cast("string").alias("description")
    )
    resolved = n.select(F.col("n_name").alias("reference"), F.col("n_nationkey").cast("string").alias("id"), F.lit(80).alias("confidence"))
    made, links = graph.asset_links(edges, nodes, resolved, n.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")))
    count = lambda c: F.countDistinct(c)
    return links.agg(F.lit("edge").alias("part"), F.count(F.lit(1)).alias("n"), count("source_ref").alias("sources"), count("target_ref").alias("targets")).unionByName(
        made.agg(F.lit("node").alias("part"), F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("sources"), count("id").alias("targets"))
    )


@query(
    """
    select user_id::varchar as key, epoch_us(min(ts)) as first_us, epoch_us(max(ts)) as last_us, arg_max(event_type, ts) as content,
           count(*) filter (changed) as versions
    from (select user_id, ts, event_type, lag(event_type) over (partition by user_id order by ts, event_type) is distinct from event_type as changed from events)
    group by user_id
    """
)
def q39_stream_state(spark, sf_dir):
    """The whole event table as a stream, folded into keyed state; the last row per key is the batch result."""
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = load(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events*").parquet(sf_dir)
    folded = stream.latest_by_key(events, "user_id", "ts", "event_type", "60 days")

    def each(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/rows/b={number}")

    stream.run_available(folded, each, f"{out}/checkpoint")
    rows = spark.read.parquet(f"{out}/rows")
    last = relational.first_of(rows, ["key"], F.desc("batch"))
    return last.select("key", F.unix_micros("first_seen").alias("first_us"), F.unix_micros("last_seen").alias("last_us"), "content", "versions")


@query(
    """
    select event_id, case event_id % 4 when 0 then 'whole' when 1 then 'whole' when 2 then 'whole' else null end as how,
           case when event_id % 4 < 3 then (props->>'$.k')::integer end as k,
           case when event_id % 4 = 3 then 1 end::integer as salvaged
    from events
    """
)
def q40_json_ladder(spark, sf_dir):
    e, k = load(spark, sf_dir, "events"), F.col("event_id") % 4
    raw = (
        F.when(k == 0, F.col("props"))
        .when(k == 1, F.concat(F.lit("Here you are:\n```json\n"), "props", F.lit("\n```\nbye")))
        .when(k == 2, F.concat(F.lit("the object "), "props"))
        .otherwise(F.concat(F.lit('{"entities": ['), "props", F.lit(', {"k": "a } b')))
    )
    found = e.select("event_id", raw.alias("raw")).withColumn("json", jsontext.ladder("raw"))
    found = found.withColumn("saved", F.when(F.col("json").isNull(), jsontext.salvaged("raw")))
    return found.select(
        "event_id",
        F.when(F.col("json").isNotNull(), "whole").alias("how"),
        F.get_json_object("json", "$.k").try_cast("int").alias("k"),
        F.size(F.from_json("saved", "struct<entities:array<struct<k:int>>>")["entities"]).alias("salvaged"),
    )


@query(
    """
    select user_id as run_id, coalesce(nullif(event_type, 'view'), 'unknown') as tier, count(*) filter (event_type <> 'signup') as calls,
           coalesce(sum((props->>'$.k')::bigint) filter (event_type <> 'signup'), 0)::bigint as output_chars from events group by 1, 2
    """
)
def q43_tier_totals(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    task = F.when(F.col("event_type") != "view", F.col("event_type"))
    payload = F.to_json(F.struct(task.alias("task"), F.get_json_object("props", "$.k").alias("chars")))
    what = F.when(F.col("event_type") == "signup", "llm_call_start").otherwise("llm_call_done")
    return metrics.per_tier(e.select(F.col("user_id").alias("run_id"), what.alias("event"), payload.alias("payload")))


@query(
    """
    with x as (select doc_id, case doc_id % 6 when 0 then 'ipv4' when 1 then 'nope' else 'fqdn' end as type, case doc_id % 5 when 0 then '  ' else ' v' || doc_id || ' ' end as value,
               case doc_id % 7 when 0 then 1.5 else 0.5 end as c, doc_id % 9 = 0 as extra from documents)
    select doc_id as url, type, trim(value) as value from x where type <> 'nope' and trim(value) <> '' and c <= 1 and not extra
    """
)
def q44_ioc_validation(spark, sf_dir):
    i = F.col("doc_id")
    entry = F.struct(
        F.when(i % 6 == 0, "ipv4").when(i % 6 == 1, "nope").otherwise("fqdn").alias("type"),
        F.when(i % 5 == 0, "  ").otherwise(F.concat(F.lit(" v"), i, F.lit(" "))).alias("value"),
        F.when(i % 7 == 0, 1.5).otherwise(0.5).alias("confidence"),
        F.when(i % 9 == 0, "x").alias("more"),
    )
    d = load(spark, sf_dir, "documents").select(i.alias("url"), F.to_json(F.struct(F.array(entry).alias("iocs"))).alias("json"))
    return gate.iocs(d).select("url", "type", "value")
