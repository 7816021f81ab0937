"""One function per command: what a user of the engine runs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sinks, vocab
from .functions import jsontext, scalar, text
from .operators import discovery, extraction, fields, gate, graph, integrity, metrics, resolve, state
from .operators.relational import first_of
from .session import kept
from .sources import documents

#: A model takes (key columns, prompt) rows and gives the same rows with ``response``: a service, or a table that is replayed.
Model = Callable[[DataFrame], DataFrame]


def replayed(responses: DataFrame, keys: list[str]) -> Model:
    """A model that answers from a table."""
    return lambda prompts: prompts.join(responses.select(*keys, "response"), keys, "left")


@dataclass
class Extraction:
    """Merged tables of an extraction run."""

    entities: DataFrame
    relationships: DataFrame
    asset_edges: DataFrame
    accounts: DataFrame
    identity_edges: DataFrame
    raw_entities: DataFrame


SCALARS = (
    "name description pattern pattern_type identity_class primary_motivation sophistication is_family valid_from".split()
)
#: Bytes of a bundle's text up to which its objects are compared within its row.
LONG_BUNDLE = 1 << 20
LISTS = "labels aliases malware_types tool_types kill_chain_phases external_references sectors secondary_motivations".split()


def discover(
    pirs: DataFrame, entries: DataFrame, start: str, end: str, most: int = 50, include_recent: bool = False
) -> DataFrame:
    """Ranked candidates from feed entries (source, url, title, summary, published_at, ord)."""
    terms = discovery.build_terms(discovery.term_branches(pirs))
    s, e = F.lit(start), F.lit(end)
    body = F.concat_ws(" ", "title", "summary", "url")
    inside = entries.where(discovery.in_window("published_at", s, e)).withColumn("body", body)
    matches = discovery.match_terms(inside, terms).drop("body")
    scored = discovery.score(matches, ["url", "title", "summary", "source", "ord"], "published_at", s, e)
    merged = discovery.merge(scored, text.url_key("url"), ["url", "title", "summary", "source", "published_at"], "ord")
    recent = None
    if include_recent and terms.limit(1).count():  # without a term nothing is returned
        first = inside.withColumn("url_key", text.url_key("url")).withColumn("score", F.lit(0.0)).drop("body")
        recent = first_of(first, ["url_key"], "ord")
    return discovery.rank(merged, most, recent)


def relevance(articles: DataFrame, context: str | None, model: Model, names: list[str] = (), limit: int = 3000) -> DataFrame:
    """Articles (url, text) with ``verdict`` and the response they got; failures of the model are failed verdicts.

    Without ``context``, each article brings its own in a column of that name.
    """
    template = "Requirements:\n{{CONTEXT}}\n\nArticle:\n{{ARTICLE}}"
    about = F.col("context") if context is None else F.lit(context)
    prompts = articles.withColumn("prompt", documents.prompt(template, {"CONTEXT": about, "ARTICLE": text.clipped("text", limit)}))
    answered = model(prompts).withColumn("verdict", gate.verdict(F.coalesce("response", F.lit(""))))
    score = gate.boosted(F.col("verdict.score"), F.col("verdict.failed"), F.col("text"), list(names))
    return answered.withColumn("verdict", F.col("verdict").withField("score", score)).drop("prompt")


def extract(articles: DataFrame, model: Model, chunk_chars: int = 12_000, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> Extraction:
    """Chunks of articles (doc_id, text and what else the model is to see, as ``task``) through the model, then coerced and merged per document.

    With ``keep`` (see :func:`crawl_batch`) responses are written once; without it, each table of the result asks the model anew.
    """
    more = [c for c in articles.columns if c not in ("doc_id", "text")]
    chunks = articles.select("doc_id", *more, F.posexplode_outer(text.chunks("text", chunk_chars)).alias("chunk", "prompt")).where("prompt is not null")
    answered = model(chunks).select("doc_id", "chunk", jsontext.extraction_json("response").alias("json"))
    answered = keep(answered, "responses") if keep is not None else answered  # before the filter, which would be pushed below the model
    responses = extraction.parsed(answered.where("json is not null"))
    ents = extraction.entities(responses)
    merged, aliases = extraction.merge_entities(ents, SCALARS, LISTS)
    return Extraction(
        merged,
        extraction.merge_relationships(extraction.relationships(responses), aliases),
        extraction.merge_asset_edges(extraction.asset_edges(responses), aliases),
        extraction.merge_accounts(extraction.accounts(responses), aliases),
        extraction.merge_asset_edges(
            extraction.identity_edges(responses).withColumn("asset_reference", F.concat_ws("\0", "relationship_type", "target_identity_reference")), aliases
        ).drop("asset_reference"),
        ents,
    )


def assemble(
    x: Extraction,
    now: Column,
    assets: DataFrame | None = None,
    identities: DataFrame | None = None,
    taxonomy: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, edges and dropped rows (doc_id, reason) of merged extractions.

    With a ``taxonomy`` (group_norm, tags), actors carry the tags of the groups that they name.
    """
    spark = x.entities.sparkSession
    nodes, lost_nodes = graph.assemble_nodes(x.entities, now)
    if taxonomy is not None:
        acting = F.col("type").isin("threat-actor", "intrusion-set")
        actors = graph.enrich(nodes.where(acting).withColumn("key", F.struct("doc_id", "canonical")), taxonomy, "key").drop("key", "n_added")
        nodes = nodes.where(~acting).unionByName(actors)
    edges, lost_edges = graph.assemble_edges(x.relationships, nodes, graph.triples(spark))
    more_nodes, more_edges = [], []
    if assets is not None:
        refs = x.asset_edges.select(F.col("asset_reference").alias("reference")).union(
            x.accounts.select(F.explode("asset_references").alias("reference"))
        )
        resolved = resolve.resolve_assets(refs, assets)
        made, links = graph.asset_links(x.asset_edges, nodes, resolved, assets.select("id", "name"))
        people, on = graph.account_links(x.accounts, nodes, resolved)
        reached = on.where(F.col("relationship_type") == vocab.VALID_ON).select("doc_id", F.col("target_ref").alias("id")).distinct()
        named = assets.select(
            F.concat(F.lit(f"{vocab.ASSET_NODE}--"), scalar.uuid5(vocab.NS_ASSET, "id")).alias("id"), F.col("id").alias("asset_id"), "name"
        )
        others = reached.join(made, ["doc_id", "id"], "left_anti").join(named, "id").withColumn("type", F.lit(vocab.ASSET_NODE))
        more_nodes += [made, others, people]
        more_edges += [links, on]
    if identities is not None:
        refs = x.identity_edges.select(F.col("target_identity_reference").alias("reference"))
        made, links = graph.identity_links(x.identity_edges, nodes, resolve.resolve_identities(refs, identities))
        more_nodes.append(made)
        more_edges.append(links)
    for df in more_nodes:
        nodes = nodes.unionByName(df, allowMissingColumns=True)
    for df in more_edges:
        edges = edges.unionByName(df, allowMissingColumns=True)
    return nodes, edges, lost_nodes.select("doc_id", "reason").unionByName(lost_edges.select("doc_id", "reason"))


@dataclass
class Crawl:
    outcomes: DataFrame
    bundles: DataFrame
    state: DataFrame
    hash_cache: DataFrame | None = None


def crawl_batch(
    sources: DataFrame,
    fetched: DataFrame,
    old: DataFrame,
    gate_model: Model | None,
    extract_model: Model,
    context: str | None,
    pir_set_hash: str | None,
    now: Column,
    threshold: float = 0.5,
    recheck: bool = False,
    assets: DataFrame | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = kept,
    pirs: DataFrame | None = None,
    names: list[str] = (),
    identities: DataFrame | None = None,
    taxonomy: DataFrame | None = None,
    hash_cache: DataFrame | None = None,
    hashes: DataFrame | None = None,
    hash_ttl_days: int = 30,
    max_chars: int = 30_000,
    dry_run: bool = False,
) -> Crawl:
    """Fetched pages to bundles and the next state.

    sources: url, and the policy of each: task (the model's tier), max_chars, pir_ids (the
    requirements that its gate is restricted to; none: all). With ``pirs`` (see
    ``documents.load_pirs``) the gate's context is made of these for each source; else it is
    ``context``. Without ``gate_model`` nothing is gated. fetched: url, content, content_type, error
    (see ``documents.scan`` and ``replay``). ``hash_cache`` and ``hashes`` (url, sha256 of what was
    fetched anew) add hashes to external references. A dry run touches nothing. ``keep`` writes an
    intermediate table and reads it back (to the shared folder, unless another is passed), as the
    results of the models are used more than once.
    """
    none = F.array().cast("array<string>")
    policy = {"label": F.lit(None).cast("string"), "task": F.lit("medium"), "max_chars": F.lit(None).cast("int"), "pir_ids": none}
    given = sources.select("url", *(F.coalesce(F.col(c), d).alias(c) if c in sources.columns else d.alias(c) for c, d in policy.items()))
    wanted = first_of(given, ["url"], "task", "max_chars", "label")
    if dry_run:
        planned = wanted.select(
            "url", "label", F.lit("extracted").alias("kind"), F.lit(None).cast("double").alias("relevance_score"), none.alias("matched_pir_ids"), F.lit(None).cast("string").alias("error")
        )
        return Crawl(planned, planned.select("url", F.lit(None).cast("string").alias("bundle")).limit(0), old, hash_cache)
    pages = wanted.join(fetched, "url", "left").withColumn("error", F.when(F.col("content").isNull(), F.coalesce("error", F.lit("not fetched"))).otherwise(F.col("error")))
    hashed = pages.withColumn("content_sha256", F.when(F.col("content").isNotNull(), F.sha2("content", 256)))
    seen = keep(state.changed(hashed, old, pir_set_hash, recheck), "pages")
    todo = seen.where("error is null and not unchanged")
    texts = documents.articles(todo, F.coalesce(F.when(F.col("max_chars") > 0, F.col("max_chars")), F.lit(max_chars)))
    texts = texts.join(seen.select("url", "task", "pir_ids"), "url")
    if gate_model is not None:
        if pirs is not None:
            every = documents.pir_context(pirs).first()["context"]
            texts = texts.join(gate.contexts(wanted, pirs, F.lit(every), documents.pir_short()), "pir_ids")
        elif context is not None:
            texts = texts.withColumn("context", F.lit(context))
        judged = relevance(texts, None, gate_model, names)
    else:
        judged = texts.withColumns({"response": F.lit(None).cast("string"), "verdict": F.lit(None).cast(gate.READ)})
    judged = keep(judged, "judged")
    open_ = F.lit(gate_model is None)
    passed = judged.where(open_ | gate.keeps(F.col("verdict.score"), F.col("verdict.failed"), threshold))
    x = extract(passed.select(F.col("url").alias("doc_id"), "text", "task"), extract_model, keep=keep)
    if hash_cache is not None:
        refs, hash_cache = graph.hashed_references(x.entities, hash_cache, hashes, now, hash_ttl_days)
        x = replace(x, entities=keep(refs, "references"))
    read = {"entities", "relationships"} | ({"asset_edges", "accounts"} if assets is not None else set()) | ({"identity_edges"} if identities is not None else set())
    x = replace(x, **{name: keep(getattr(x, name), name) for name in sorted(read)})
    nodes, edges, _ = assemble(x, now, assets, identities, taxonomy)
    meta = judged.select(
        F.col("url").alias("doc_id"),
        F.col("url").alias("source_url"),
        F.col("verdict.matched_pir_ids").alias("matched_pir_ids"),
        F.col("verdict.score").alias("relevance_score"),
        F.col("verdict.rationale").alias("relevance_rationale"),
    )
    made = keep(graph.bundles(nodes, edges, now, meta), "bundles").withColumnRenamed("doc_id", "url")
    per_url = seen.select("url", "label", "error", "unchanged", "content_sha256").join(judged.select("url", "verdict", "response", F.lit(True).alias("read")), "url", "left").join(made, "url", "left")
    outcomes = per_url.withColumn(
        "kind",
        F.when(F.col("error").isNotNull(), "fetch_failed")
        .when(F.col("unchanged"), "skipped_unchanged")
        .when(F.col("read").isNull(), "extraction_failed")  # no text was left of the page
        .when(~open_ & ~gate.keeps(F.col("verdict.score"), F.col("verdict.failed"), threshold), "skipped_below_threshold")
        .when(F.col("bundle").isNull(), "no_objects")
        .otherwise("extracted"),
    )
    found = gate.iocs(outcomes.where("response is not null").withColumn("json", jsontext.ladder("response")))
    listed = found.groupBy("url").agg(F.array_sort(F.collect_list(F.struct("pos", F.struct("type", "value", "confidence", "context_snippet").alias("i")))).alias("l"))
    listed = listed.select("url", F.transform("l", lambda r: r["i"]).alias("iocs"))
    no_iocs = F.expr("cast(array() as array<struct<type:string,value:string,confidence:double,context_snippet:string>>)")
    touched = outcomes.where(F.col("kind").isin("extracted", "skipped_below_threshold", "no_objects")).join(listed, "url", "left")
    updates = touched.select(
        "url",
        "content_sha256",
        F.when(F.col("kind") == "extracted", F.concat(F.lit("stix/bundle_"), text.slug("url"), F.lit(".json"))).alias("bundle_path"),
        F.struct(
            F.when(F.col("kind") == "extracted", F.when(open_, "no_pir").otherwise("kept")).when(F.col("kind") == "no_objects", "extraction_failed").otherwise(F.col("kind")).alias("decision"),
            F.col("verdict.score").alias("score"),
            F.coalesce("verdict.matched_pir_ids", none).alias("matched_pir_ids"),
            F.col("verdict.rationale").alias("rationale"),
            F.lit(pir_set_hash).alias("pir_set_hash"),
        ).alias("relevance"),
        F.coalesce("iocs", no_iocs).alias("iocs"),
    )
    why = F.when(F.col("kind") == "extraction_failed", F.coalesce("error", F.lit("empty article text"))).otherwise(F.col("error"))
    summary = outcomes.select(
        "url", "label", "kind", F.col("verdict.score").alias("relevance_score"), F.col("verdict.matched_pir_ids").alias("matched_pir_ids"), why.alias("error")
    )
    return Crawl(summary, made, state.upsert(old, updates, now), hash_cache)


def search_iocs(crawl_state: DataFrame, bundle_texts: DataFrame, ioc: str, tlp_max: str = "amber", kind: str | None = None) -> DataFrame:
    """Where an indicator was seen, of the bundles (path, value) that may be shown."""
    tlp = gate.bundle_tlp(documents.markings(bundle_texts))
    return gate.search(state.ioc_index(crawl_state), tlp, ioc, tlp_max, kind)


def validate_bundle(texts: DataFrame, strict: bool = False, known_identities: DataFrame | None = None, extra: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Findings for bundles (path, value), each path one bundle; ``extra`` may add those of an external rule set.

    Bundles are checked within their rows; texts beyond ``LONG_BUNDLE`` bytes, if there are any, by joins.
    """
    spark = texts.sparkSession
    long = F.coalesce(F.octet_length("value") > LONG_BUNDLE, F.lit(False))
    found = [integrity.check_texts(texts.where(~long), vocab.ATTRIBUTION, known_identities)]
    large = texts.where(long)
    if not large.isEmpty():
        heads, nodes, edges = documents.load_bundles(large)
        found += [integrity.check_bundle(heads, nodes, edges), integrity.check_attribution(nodes, edges, graph.triples(spark, vocab.ATTRIBUTION))]
        if known_identities is not None:
            found.append(integrity.check_identity_refs(nodes, known_identities))
    if extra is not None:
        found.append(extra(texts))
    out = integrity.union(found)
    return integrity.strict(out) if strict else out


def validate_assets(tables: dict[str, DataFrame]) -> DataFrame:
    return integrity.asset_fields(tables).unionByName(integrity.check_assets(tables))


def validate_identity_assets(tables: dict[str, DataFrame], assets: DataFrame) -> DataFrame:
    """Field rules first; references only where these hold."""
    fields = integrity.identity_fields(tables)
    return fields if integrity.has_errors(fields) else fields.unionByName(integrity.check_identities(tables, assets))


def validate_user_accounts(tables: dict[str, DataFrame], assets: DataFrame, identities: DataFrame | None = None) -> DataFrame:
    fields = integrity.account_fields(tables)
    return fields if integrity.has_errors(fields) else fields.unionByName(integrity.check_accounts(tables, assets, identities))


def validate_pir(pirs: DataFrame, tags: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    return integrity.pir_fields(pirs).unionByName(integrity.check_pirs(pirs, tags, assets))


def validate_documents(
    kind: str, raw: DataFrame, assets: DataFrame | None = None, identities: DataFrame | None = None, tags: DataFrame | None = None
) -> DataFrame:
    """Findings of one configuration document from its JSON text (path, value): field rules first, references only where these hold.

    kind: assets, identity_assets, user_accounts, pir or sources; the others' documents are texts too.
    """
    found = fields.check(raw, kind)
    if kind == "pir":
        envelope = fields.check_pir_envelope(raw)
        found = envelope if not envelope.isEmpty() else found
    plain = found.drop("path")
    if kind == "sources" or integrity.has_errors(found):
        return plain
    inventory = fields.tables(assets, "assets") if assets is not None else None
    if kind == "assets":
        return plain.unionByName(integrity.check_assets(fields.tables(raw, kind)))
    if kind == "identity_assets":
        return plain.unionByName(integrity.check_identities(fields.tables(raw, kind), inventory["assets"]))
    if kind == "user_accounts":
        people = fields.tables(identities, "identity_assets")["identities"] if identities is not None else None
        return plain.unionByName(integrity.check_accounts(fields.tables(raw, kind), inventory["assets"], people))
    return plain.unionByName(integrity.check_pirs(documents.load_pirs(raw), tags, inventory["assets"] if inventory else None))


def validate_all(sections: dict[str, DataFrame], shown: int = 1000, write: Callable[[DataFrame], None] | None = None) -> tuple[str, bool]:
    """One Markdown report over sections of findings, and whether it passes.

    Totals cover all findings. The report shows the first ``shown`` and says how many more there
    are; ``write`` gets every finding as a line of its section's table (see ``sinks.report_lines``).
    """
    spark = next(iter(sections.values())).sparkSession
    found = integrity.union([df.withColumn("section", F.lit(k)) for k, df in sections.items()])
    totals = integrity.totals(found, spark.createDataFrame([(k,) for k in sections], "section string")).collect()
    if write is not None:
        write(sinks.report_lines(found))
    listed = found.orderBy("section", "severity", "code", "location").limit(shown).collect()
    everything = next((sum(r[f"n_{s}"] for s in vocab.SEVERITIES) for r in totals if r["section"] is None), 0)
    report = sinks.report(totals, listed)
    if everything > len(listed):
        report += f"\n{everything - len(listed)} more findings aren't shown here.\n"
    return report, all(r["n_error"] == 0 for r in totals)


def submit_report(report: str, passed: bool, post: Callable[[dict], dict] | None = None, show: Callable[[str], None] = print, title: str = "Validation report") -> dict | None:
    """A report printed, or, with ``post``, handed to the issue tracker."""
    if post is None:
        show(report)
        return None
    return sinks.issue(f"{title}: {'PASS' if passed else 'FAIL'}", report, post)


def enrich_bundles(actors: DataFrame, taxonomy: DataFrame) -> DataFrame:
    return graph.enrich(actors, graph.index_tags(taxonomy))


def enrich_bundle_texts(texts: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(path, value, n_enriched): bundles rewritten with the tags of the taxonomy; write ``value`` with a sink."""
    return graph.enriched_bundles(texts, graph.index_tags(taxonomy))


def run_metrics(events: DataFrame) -> DataFrame:
    """One row per run of an event log (run_id, seq, event, payload)."""
    return metrics.fold(events)


COMMANDS = {
    f.__name__: f
    for f in (
        discover,
        relevance,
        extract,
        assemble,
        crawl_batch,
        search_iocs,
        validate_bundle,
        validate_assets,
        validate_identity_assets,
        validate_user_accounts,
        validate_pir,
        validate_documents,
        validate_all,
        submit_report,
        enrich_bundles,
        enrich_bundle_texts,
        run_metrics,
    )
}
