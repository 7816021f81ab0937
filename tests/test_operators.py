"""Operators against small fixtures; expectations are written out."""

import json
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sigloom import api, sinks, vocab
from sigloom.functions import jsontext, scalar, text
from sigloom.operators import discovery, extraction, gate, graph, integrity, metrics, relational, resolve, state
from sigloom.sources import documents, feeds
from sigloom.streaming import crawl

NOW = "2026-06-30 12:00:00"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def now():
    return F.lit(NOW).cast("timestamp")


# --- functions --------------------------------------------------------------------------------


@pytest.mark.parametrize("value", ["  a b ", " X ", "\n\tÄß ", "", "İ x"])
def test_normal(spark, value):
    assert one(spark, text.normal(F.lit(value))) == value.strip().lower()


def test_terms(spark):
    cases = {" The_Lazarus  Group. ": "the lazarus group", "the": None, "ab": None, "x" * 81: None, "(APT28)": "apt28"}
    for raw, want in cases.items():
        assert one(spark, text.term(F.lit(raw))) == want
    assert one(spark, text.keywords(F.lit("Monitor ransomware from Ransomware gangs, abc, with zero-day"))) == ["ransomware", "gangs", "zero-day"]


def test_contains_term(spark):
    assert one(spark, text.contains_term(F.lit("a zero day bug"), F.lit("zero-day")))
    assert one(spark, text.contains_term(F.lit(None).cast("string"), F.lit("x"))) is False


def test_urls(spark):
    assert one(spark, text.url_key(F.lit(" HTTP://X.org/A// "))) == "http://x.org/a"
    assert one(spark, text.slug(F.lit("https://X.org/A?b=1"))) == "X.org-A-b-1"
    assert one(spark, text.slug(F.lit("https://"))) == "bundle"


def test_chunks(spark):
    assert one(spark, text.chunks(F.lit("aa\n\nbb\n \ncccc\n\ndddddddddd\n\ne"), 6)) == ["aa\n\nbb", "cccc", "dddddd", "dddd", "e"]
    assert one(spark, text.chunks(F.lit("a\n\n\nb"), 6)) == ["a\n\n\nb"] and one(spark, text.chunks(F.lit(""), 6)) == [""]


def test_indicator_names(spark):
    cases = {"[ipv4-addr:value = '1.2.3.4']": "ipv4-addr: 1.2.3.4", "[file:size = 3]": "Indicator: file", "": "Indicator", "x": "Indicator"}
    for pattern, want in cases.items():
        assert one(spark, text.indicator_name(F.lit(pattern))) == want


@pytest.mark.parametrize(
    "phrase,want", [("Almost certain", 95), ("very likely", 85), ("highly unlikely", 15), ("improbable", 30), ("probable", 70), ("no evidence", 5), ("50/50", 50), ("red", None)]
)
def test_hedges(spark, phrase, want):
    assert one(spark, text.hedge_confidence(F.lit(f"It is {phrase} that"))) == want


def test_uuid5(spark):
    for key in ("tool\0mimikatz", "é", ""):
        assert one(spark, scalar.uuid5(vocab.NS_ENTITY, F.lit(key))) == str(uuid.uuid5(vocab.NS_ENTITY, key))
    assert one(spark, scalar.uuid5(vocab.NS_ENTITY, F.lit(None).cast("string"))) is None
    none = F.lit(None).cast("string")
    assert one(spark, scalar.entity_id(F.lit("attack-pattern"), F.lit("x"), F.lit("T1566.001 "), none)) == f"attack-pattern--{uuid.uuid5(vocab.NS_ENTITY, 'T1566.001')}"
    assert one(spark, scalar.entity_id(F.lit("campaign"), F.lit("x"), none, none, F.lit("z"))) == "campaign--z"


def test_scores(spark):
    for raw, want in (("0.4", 0.4), ("7", 1.0), ("-1", 0.0), ("x", 0.0), ("NaN", 1.0), (None, 0.0)):
        assert one(spark, scalar.clamped(F.lit(raw).cast("string"))) == want


def test_feed_type(spark):
    t = lambda o, m, c: one(spark, scalar.feed_type(F.lit(o).cast("string"), F.lit(m).cast("string"), F.lit(c).cast("binary")))
    assert t("atom", "text/html", "") == "atom"
    assert t(None, "application/rss+xml; charset=utf-8", "") == "rss"
    assert t(None, "text/xml", "<?xml?><feed xmlns='x'>") == "atom"
    assert t(None, "text/html", "<rss>") == "html"
    assert t(None, None, None) == "html"


# --- JSON -------------------------------------------------------------------------------------


def test_ladder_and_salvage(spark):
    cases = {
        '{"a": 1}': '{"a": 1}',
        'x\n```json\n{"a": 2}\n```\n': '{"a": 2}',
        'so: {"a": 3}': '{"a": 3}',
        '{"entities": [{"n": "a } b"}, {"n": "c"}, {"n": "d': '{"entities":[{"n": "a } b"},{"n": "c"}]}',
        "none": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    got = {r["raw"]: r["j"] for r in df.select("raw", jsontext.extraction_json("raw").alias("j")).collect()}
    assert got == cases


def test_partial_verdict(spark):
    assert one(spark, jsontext.partial_verdict(F.lit('{"score": 0.7, "matched_pir_ids": ["a", "b"], "rat')))["matched_pir_ids"] == ["a", "b"]
    assert one(spark, jsontext.partial_verdict(F.lit('{"score": -1'))) is None
    assert one(spark, jsontext.partial_verdict(F.lit("no"))) is None


# --- discovery --------------------------------------------------------------------------------

RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>t</title>
<item><title><![CDATA[FIN7 <b>phishing</b>]]></title><link>https://x.org/a</link><description>wave</description><pubDate>Wed, 10 Jun 2026 10:00:00 GMT</pubDate></item>
<item><title>FIN7 phishing</title><link>https://x.org/a/</link><pubDate>Wed, 10 Jun 2026 10:00:00 +0200</pubDate></item>
<item><title>FIN7 old</title><link>https://x.org/b</link><pubDate>Wed, 10 Jun 2020 10:00:00 GMT</pubDate></item>
<item><title>weather</title><link>https://x.org/c</link></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>e</title><link rel="self" href="https://x.org/self"/><link rel="alternate" href="https://x.org/e"/>
<updated>2026-06-11T00:00:00Z</updated><summary>s</summary></entry></feed>"""


def feed_rows(spark):
    return feeds.entries(spark.createDataFrame([("r", RSS), ("a", ATOM), ("bad", "<rss><channel>"), ("no", "x")], "feed_url string, content string"))


def test_feed_entries(spark):
    got = {(r["feed_url"], r["url"]): r for r in feed_rows(spark).collect()}
    assert len(got) == 5
    assert got["r", "https://x.org/a"]["title"] == "FIN7 phishing"
    assert got["r", "https://x.org/a"]["published_at"].isoformat() == "2026-06-10T10:00:00"
    assert got["r", "https://x.org/c"]["published_at"] is None
    assert got["a", "https://x.org/e"]["published_at"] is not None


def test_recent_keeps_one_at_least(spark):
    assert feeds.recent(feed_rows(spark).where("feed_url = 'r'"), now(), 90, 0).count() == 1
    assert feeds.recent(feed_rows(spark).where("feed_url = 'r'"), now(), 90, 9).count() == 3


def pirs(spark):
    doc = {
        "schema_version": "2.0.0",
        "pirs": [
            {"pir_id": "P1", "threat_actor_tags": ["fin7"], "description": "phishing against banks", "prioritized_actors": [{"name": "FIN7", "aliases": ["Carbanak"]}], "asset_weight_rules": [{"tag": "pos"}]}
        ],
    }
    return documents.load_pirs(spark.createDataFrame([(json.dumps(doc),), ("[1]",)], "value string"))


def test_terms_in_order_and_capped(spark):
    terms = discovery.build_terms(discovery.term_branches(pirs(spark)))
    got = {r["term"]: (r["category"], r["weight"]) for r in terms.collect()}
    assert got["fin7"] == ("actor", 0.5) and got["carbanak"] == ("actor_alias", 0.5) and got["phishing"] == ("description", 0.1)
    assert discovery.build_terms(discovery.term_branches(pirs(spark)), 1).collect()[0]["term"] == "fin7"


def test_discover(spark):
    entries = feed_rows(spark).where("feed_url = 'r'").withColumns({"source": F.col("feed_url"), "ord": F.col("pos")})
    got = api.discover(pirs(spark), entries, "2026-06-01", "2026-06-30").collect()
    assert [r["url"] for r in got] == ["https://x.org/a"] and got[0]["matched_terms"] == ["fin7", "phishing"]
    more = api.discover(pirs(spark), entries, "2026-06-01", "2026-06-30", include_recent=True).collect()
    assert [r["url"] for r in more] == ["https://x.org/a", "https://x.org/c"] and more[1]["score"] == 0.0
    assert api.discover(pirs(spark), entries, "2026-06-01", "2026-06-30", most=0).count() == 0
    assert json.loads(sinks.candidate_envelope(api.discover(pirs(spark), entries, "2026-06-01", "2026-06-30").withColumn("ord_out", F.lit(0))).first()["json"])["candidates"]


def test_expanded_sources(spark):
    src = spark.createDataFrame([("r", "Feed", "medium", 10, ["P1"], "rss"), ("p", "Page", "simple", 10, [], None)], documents.SOURCES)
    got = feeds.expanded(src, feed_rows(spark)).collect()
    assert {r["url"]: r["label"] for r in got}["https://x.org/c"] == "Feed: weather" and {r["feed_type"] for r in got} == {"html"} and len(got) == 5


# --- resolution -------------------------------------------------------------------------------


def test_asset_tiers(spark):
    assets = spark.createDataFrame([("1", "Mail Gateway", ["smtp"]), ("2", "Web", ["http"]), ("3", "Web Shop", ["http"]), ("4", None, ["solo"])], "id string, name string, tags array<string>")
    refs = [" mail gateway", "the mail gateway host", "gate", "web", "http", "solo", "ma", "", "Shop"]
    got = {r["reference"]: (r["id"], r["tier"], r["confidence"]) for r in resolve.resolve_assets(spark.createDataFrame([(r,) for r in refs], "reference string"), assets).collect()}
    assert got == {" mail gateway": ("1", 1, 80), "the mail gateway host": ("1", 2, 50), "gate": ("1", 2, 50), "web": ("2", 1, 80), "solo": ("4", 3, 30), "Shop": ("3", 2, 50)}


def test_identity_tiers(spark):
    ids = spark.createDataFrame([("1", "Ann Lee", ["CFO"], ["finance"]), ("2", "Bo", None, ["energy"])], "id string, name string, roles array<string>, sectors array<string>")
    refs = spark.createDataFrame([("ann lee",), ("mail from Ann Lee",), ("cfo",), ("en",), ("nobody",)], "reference string")
    got = {r["reference"]: (r["id"], r["tier"]) for r in resolve.resolve_identities(refs, ids).collect()}
    assert got == {"ann lee": ("1", 1), "mail from Ann Lee": ("1", 2), "cfo": ("1", 3), "en": ("2", 3)}


# --- extraction and graph ---------------------------------------------------------------------

RESPONSE = {
    "entities": [
        {"local_id": "a", "type": "threat-actor", "name": "FIN7", "labels": ["x"], "primary_motivation": "fun"},
        {"local_id": "b", "type": "malware", "name": "Carbanak", "malware_types": ["backdoor", "odd"]},
        {"local_id": "c", "type": "vulnerability", "name": "CVE-2024-12345", "aliases": ["Zero"]},
        {"local_id": "d", "type": "vulnerability", "name": "a bug"},
        {"local_id": "e", "type": "indicator", "pattern": "[ipv4-addr:value = '1.2.3.4']"},
        {"local_id": "f", "type": "indicator", "pattern": "just words"},
        {"local_id": "g", "type": "identity", "name": "Ann", "identity_class": "individual"},
        {"local_id": "", "type": "malware", "name": "none"},
        {"local_id": "h", "type": "planet", "name": "none"},
    ],
    "relationships": [
        {"source": "a", "target": "b", "relationship_type": "uses"},
        {"source": "a", "target": "b", "relationship_type": "uses"},
        {"source": "b", "target": "a", "relationship_type": "uses"},
        {"source": "a", "target": "zz", "relationship_type": "uses"},
        {"source": "e", "target": "b", "relationship_type": "indicates"},
        {"source": "a", "target": "d", "relationship_type": "targets"},
    ],
    "identity_asset_edges": [{"source": "g", "asset_reference": "Mail Gateway"}],
    "user_account_observations": [{"account_login": " root ", "account_type": "odd", "identity_local_id": "g", "asset_references": ["smtp", " "]}],
}


def articles(spark):
    return spark.createDataFrame([("https://x.org/a", "first\n\nsecond")], "doc_id string, text string")


def model(spark):
    second = {"entities": [{"local_id": "z", "type": "threat-actor", "name": " fin7 ", "labels": ["y", "x"], "description": "d"}], "relationships": []}
    rows = [("https://x.org/a", 0, json.dumps(RESPONSE)), ("https://x.org/a", 1, "```json\n" + json.dumps(second) + "\n```")]
    return api.replayed(spark.createDataFrame(rows, "doc_id string, chunk int, response string"), ["doc_id", "chunk"])


def assets(spark):
    return spark.createDataFrame([("A1", "Mail Gateway", ["smtp"])], "id string, name string, tags array<string>")


def test_extract_merge_assemble(spark):
    x = api.extract(articles(spark), model(spark), chunk_chars=8)
    actor = x.entities.where("type = 'threat-actor'").collect()
    assert len(actor) == 1 and actor[0]["labels"] == ["x", "y"] and actor[0]["description"] == "d" and actor[0]["n_merged"] == 2
    assert extraction.merge_counters(x.raw_entities, x.entities).first().asDict() == {"doc_id": "https://x.org/a", "raw": 8, "merged": 7}
    nodes, edges, lost = api.assemble(x, now(), assets(spark))
    by_type = {r["type"]: r for r in nodes.collect()}
    assert by_type["malware"]["labels"] == ["odd"] and by_type["malware"]["malware_types"] == ["backdoor"] and by_type["malware"]["is_family"] is False
    assert by_type["threat-actor"]["labels"] == ["x", "y", "fun"] and by_type["threat-actor"]["primary_motivation"] is None
    assert by_type["vulnerability"]["labels"] == ["Zero"] and by_type["indicator"]["name"] == "ipv4-addr: 1.2.3.4"
    assert by_type["threat-actor"]["id"] == f"threat-actor--{uuid.uuid5(vocab.NS_ENTITY, 'threat-actor' + chr(0) + 'fin7')}"
    assert by_type["x-asset-internal"]["id"] == f"x-asset-internal--{uuid.uuid5(vocab.NS_ASSET, 'A1')}"
    assert by_type["user-account"]["account_login"] == "root" and by_type["user-account"]["account_type"] == ""
    assert sorted(r["relationship_type"] for r in edges.collect()) == sorted(["uses", "indicates", vocab.HAS_ACCESS, vocab.VALID_ON, "related-to"])
    reasons = sorted(r["reason"] for r in lost.collect())
    assert reasons == ["invalid_pattern", "no_cve", "type_mismatch", "unresolved"]  # an unknown end goes when merging, a dropped one here
    bundle = json.loads(graph.bundles(nodes, edges, now()).first()["bundle"])
    ids = [o["id"] for o in bundle["objects"]]
    assert len(ids) == len(set(ids)) and bundle["type"] == "bundle"
    assert nodes.where("type = 'x-asset-internal'").count() == 1
    found = api.validate_bundle(spark.createDataFrame([("p", json.dumps(bundle))], "path string, value string")).collect()
    assert found == []


def test_taxonomy(spark):
    tree = {"_metadata": {"tags": ["no"]}, "a": {"china": {"tags": ["apt", "cn"], "mitre_groups": ["APT1  x"]}}, "b": [{"tags": ["fin"], "mitre_groups": ["Comment Crew"]}]}
    rows = graph.taxonomy_rows(spark, tree)
    actors = spark.createDataFrame([("1", "apt1 X", ["Comment Crew"], ["cn"]), ("2", "other", None, None)], "id string, name string, aliases array<string>, labels array<string>")
    got = {r["id"]: (r["labels"], r["n_added"]) for r in api.enrich_bundles(actors, rows).collect()}
    assert got == {"1": (["cn", "apt", "fin"], 2), "2": (None, 0)}
    assert graph.taxonomy_tags(tree) == {"no", "apt", "cn", "fin"}


# --- gate and search --------------------------------------------------------------------------


def test_gate(spark):
    rows = [('{"score": 0.7, "matched_pir_ids": ["P"], "rationale": "r"}', True), ('{"score": 0.2}', False), ("garbage", True), ('{"score": 0.6, "matched_pir_ids": ["P"', True)]
    df = spark.createDataFrame(rows, "raw string, want boolean").withColumn("v", gate.verdict("raw"))
    for r in df.withColumn("keep", gate.keeps(F.col("v.score"), F.col("v.failed"), 0.5)).collect():
        assert r["keep"] is r["want"]
    assert one(spark, gate.boosted(F.lit(0.9), F.lit(False), F.lit("about ANN lee"), ["Ann Lee", " "])) == 1.0
    assert one(spark, gate.boosted(F.lit(0.0), F.lit(True), F.lit("ann lee"), ["Ann Lee"])) == 0.0


def test_iocs_and_search(spark):
    response = {"iocs": [{"type": "fqdn", "value": " Evil.example.com ", "confidence": 0.9, "context_snippet": "x" * 60}, {"type": "bad", "value": "v", "confidence": 1}, {"type": "ipv4", "value": "1", "confidence": 2}, 5]}
    found = gate.iocs(spark.createDataFrame([("u", json.dumps(response)), ("w", "[]")], "url string, json string")).collect()
    assert [(r["value"], len(r["context_snippet"])) for r in found] == [("Evil.example.com", 50)]
    mark = {v: k for k, v in vocab.TLP_MARKINGS.items()}
    texts = spark.createDataFrame([(f"b{lv}", json.dumps({"objects": [{"object_marking_refs": [mark[lv]]}, {}]})) for lv in ("clear", "green", "red")], "path string, value string")
    entry = lambda b: {"first_seen": "f", "last_seen": "l", "content_sha256": "s", "bundle_path": b, "iocs": [{"type": "fqdn", "value": "evil.example.com", "confidence": 1.0, "context_snippet": ""}]}
    doc = {"version": 1, "entries": {"u1": entry("bclear"), "u2": entry("bgreen"), "u3": entry("bred"), "u4": entry(None), "old": {"first_seen": "f"}}}
    table = documents.load_state(spark.createDataFrame([(json.dumps(doc),)], "value string"))
    assert table.where("url = 'old'").first()["iocs"] == []
    for level, n in (("clear", 2), ("green", 3), ("amber", 3), ("red", 4)):
        assert api.search_iocs(table, texts, " EVIL.example.com", level).count() == n
    assert sinks.match_table(api.search_iocs(table, texts, "evil.example.com", "red")).count() == 4


# --- validation -------------------------------------------------------------------------------


def tables(spark, **more):
    t = {
        "assets": spark.createDataFrame([(0, "a", "A", 5.0, "n", ["c"]), (1, "b", "B", 11.0, "gone", ["c", "lost"])], "pos int, id string, name string, criticality double, network_segment_id string, security_control_ids array<string>"),
        "network_segments": spark.createDataFrame([(0, "n"), (1, "n")], "pos int, id string"),
        "security_controls": spark.createDataFrame([(0, "c")], "pos int, id string"),
        "asset_vulnerabilities": spark.createDataFrame([(0, "zz")], "pos int, asset_id string"),
        "asset_connections": spark.createDataFrame([(0, "a", "q", 80)], "pos int, src string, dst string, port int"),
        "actor_targets": spark.createDataFrame([(0, "a", 101)], "pos int, asset_id string, confidence int"),
    }
    return t | more


def test_validate_assets(spark):
    got = sorted((r["code"], r["location"]) for r in api.validate_assets(tables(spark)).collect())
    assert got == sorted(
        [
            ("ASSETS_SCHEMA", "actor_targets[0].confidence"),
            ("ASSETS_SCHEMA", "assets[1].criticality"),
            ("ASSET_REF_CONTROL", "assets[1].security_control_ids[1]"),
            ("ASSET_REF_SEGMENT", "assets[1]"),
            ("CONNECTION_REF_ASSET", "asset_connections[0].dst"),
            ("ID_NOT_UNIQUE", "network_segments"),
            ("VULN_REF_ASSET", "asset_vulnerabilities[0]"),
        ]
    )


def test_validate_identities_and_accounts(spark):
    ids = {
        "identities": spark.createDataFrame([(0, "i", "Ann", "individual"), (1, "i", "Bo", "group")], "pos int, id string, name string, identity_class string"),
        "has_access": spark.createDataFrame([(0, "i", "a", "read", "2024", ""), (1, "i", "a", "read", "", ""), (2, "j", "zz", "read", "", "")], "pos int, identity_id string, asset_id string, access_level string, granted_at string, revoked_at string"),
    }
    a = tables(spark)["assets"]
    got = sorted(r["code"] for r in api.validate_identity_assets(ids, a).collect())
    assert got == ["HAS_ACCESS_DUPLICATE_PAIR", "HAS_ACCESS_REF_ASSET", "HAS_ACCESS_REF_IDENTITY", "IDENTITY_ID_NOT_UNIQUE"]
    late = ids["has_access"].withColumn("revoked_at", F.lit("2020"))
    assert {r["code"] for r in api.validate_identity_assets({**ids, "has_access": late}, a).collect()} == {"IDENTITY_ASSETS_SCHEMA"}
    acc = {
        "user_accounts": spark.createDataFrame([(0, "u", "root", "unix", "gone"), (1, "u", "x", "", "")], "pos int, id string, account_login string, account_type string, identity_id string"),
        "account_on_asset": spark.createDataFrame([(0, "u", "a", "", ""), (1, "u", "a", "", ""), (2, "w", "zz", "", "")], "pos int, user_account_id string, asset_id string, first_seen string, last_seen string"),
    }
    codes = sorted(r["code"] for r in api.validate_user_accounts(acc, a, ids["identities"]).collect())
    assert codes == ["ACCOUNT_ON_ASSET_DUPLICATE_PAIR", "ACCOUNT_ON_ASSET_REF_ASSET", "ACCOUNT_ON_ASSET_REF_USER_ACCOUNT", "USER_ACCOUNT_ID_NOT_UNIQUE", "USER_ACCOUNT_REF_IDENTITY"]
    assert "USER_ACCOUNT_REF_IDENTITY" not in {r["code"] for r in api.validate_user_accounts(acc, a).collect()}


def test_validate_pirs(spark):
    tags = spark.createDataFrame([("apt",)], "tag string")
    owned = tables(spark)["assets"].withColumn("tags", F.array(F.lit("web")))
    assert sorted(r["code"] for r in api.validate_pir(pirs(spark), tags, owned).collect()) == ["PIR_RULE_TAG_UNUSED", "PIR_TAG_NOT_IN_TAXONOMY"]
    versions = spark.createDataFrame([("2.0.0",), ("1.1.0",), ("9",), (None,)], "schema_version string")
    assert integrity.version_findings(versions).count() == 3


def test_validate_bundle_and_report(spark):
    bundle = {
        "type": "thing",
        "objects": [
            {"type": "threat-actor", "id": "threat-actor--1", "name": "x"},
            {"type": "threat-actor", "id": "threat-actor--1"},
            {"type": "attack-pattern", "id": "attack-pattern--1", "kill_chain_phases": [{"kill_chain_name": "other", "phase_name": "p"}]},
            {"type": "x-identity-internal", "id": "x-identity-internal--1", "identity_id": "nobody"},
            {"type": "relationship", "id": "relationship--1", "relationship_type": "impersonates", "source_ref": "threat-actor--1", "target_ref": "malware--9"},
            {"type": "relationship", "id": "relationship--2", "relationship_type": "uses", "source_ref": "threat-actor--1"},
        ],
    }
    texts = spark.createDataFrame([("p", json.dumps(bundle)), ("broken", "{")], "path string, value string")
    known = spark.createDataFrame([("someone",)], "id string")
    found = api.validate_bundle(texts, known_identities=known)
    codes = sorted(r["code"] for r in found.where("location not like 'bundle%'").collect())
    assert codes == ["IDENTITY_REF_RESOLUTION", "KILL_CHAIN_NAME", "RELATIONSHIP_TYPE_MATCH", "REL_REF_MISSING", "REL_REF_UNRESOLVED", "STIX_ID_NOT_UNIQUE"]
    assert found.where("code = 'BUNDLE_TYPE'").count() == 2
    assert not api.validate_bundle(texts, strict=True, known_identities=known).where("severity = 'warning'").count()
    report, passed = api.validate_all({"bundle": found, "empty": found.limit(0)})
    assert not passed and "| empty | 0 | 0 | 0 | PASS |" in report and "FAIL" in report
    assert len(sinks.issue("t" * 300, report, lambda d: d)["title"]) <= 256


# --- state, cache, metrics --------------------------------------------------------------------


def test_state_upsert_and_skip(spark, tmp_path):
    old = spark.createDataFrame([], state.STATE)
    row = [("u", "h1", None, None, []), ("v", "h2", None, None, [])]
    ddl = "url string, content_sha256 string, bundle_path string, relevance struct<decision:string,score:double,matched_pir_ids:array<string>,rationale:string,pir_set_hash:string>, iocs array<struct<type:string,value:string,confidence:double,context_snippet:string>>"
    one_ = state.upsert(old, spark.createDataFrame(row, ddl), F.lit("2026-01-01").cast("timestamp"))
    two = state.upsert(one_, spark.createDataFrame([("u", "h3", None, None, [])], ddl), F.lit("2026-01-02").cast("timestamp"))
    got = {r["url"]: (r["first_seen"][:10], r["last_seen"][:10], r["content_sha256"]) for r in two.collect()}
    assert got == {"u": ("2026-01-01", "2026-01-02", "h3"), "v": ("2026-01-01", "2026-01-01", "h2")}
    fetched = spark.createDataFrame([("u", "h3"), ("v", "new"), ("w", "x"), ("n", None)], "url string, content_sha256 string")
    assert {r["url"]: r["unchanged"] for r in state.changed(fetched, two).collect()} == {"u": True, "v": False, "w": False, "n": False}
    assert state.changed(fetched, two, "p", recheck=True).where("unchanged").count() == 0
    each = crawl.upserting(str(tmp_path / "s"), F.lit("2026-01-01").cast("timestamp"))
    each(spark.createDataFrame(row, ddl), 0)
    each(spark.createDataFrame(row[:1], ddl), 1)
    each(spark.createDataFrame(row[:1], ddl), 1)
    assert sinks.current(spark, str(tmp_path / "s")).count() == 2


def test_hash_cache(spark):
    cache = spark.createDataFrame([("a", "ha", "2026-06-29T00:00:00.000Z", "ok"), ("b", "hb", "2020-01-01T00:00:00.000Z", "ok"), ("c", "hc", "junk", "ok"), ("f", None, "2026-06-29T00:00:00.000Z", "failed")], "url string, sha256 string, fetched_at string, status string")
    refs = spark.createDataFrame([(u,) for u in "abcdf"] + [(None,)], "url string")
    fetched = spark.createDataFrame([("b", "nb")], "url string, sha256 string")
    got, after = state.with_hashes(refs, cache, fetched, now())
    assert {r["url"]: r["sha256"] for r in got.collect()} == {"a": "ha", "b": "nb", "c": None, "d": None, "f": None, None: None}
    assert {r["url"]: r["status"] for r in after.collect()} == {"a": "ok", "b": "ok", "c": "failed", "d": "failed", "f": "failed"}


def test_metrics(spark):
    ev = [("r", 1, "url_converted", {"chars": 5}), ("r", 2, "url_converted", {"chars": 9}), ("r", 3, "llm_call_done", {"task": "medium", "chars": 4}), ("r", 4, "llm_call_done", {"chars": "x"}), ("r", 5, "relevance_call_failed", {})]
    df = spark.createDataFrame([(a, b, c, json.dumps(d)) for a, b, c, d in ev], "run_id string, seq long, event string, payload string")
    r = api.run_metrics(df).first()
    assert (r["input_chars"], r["llm_calls"], r["llm_output_chars"], r["l2_failed"], r["refs_failed"]) == (9.0, 2, 4.0, True, 0)
    assert {x["tier"]: x["calls"] for x in metrics.per_tier(df).collect()} == {"medium": 1, "unknown": 1}
    assert "input chars" in metrics.summary(r)


# --- documents and the batch ------------------------------------------------------------------


def test_scan_and_retry(spark):
    waits = []
    calls = {"n": 0}

    def flaky(url):
        calls["n"] += 1
        if calls["n"] < 3:
            raise OSError("down")
        return 200, b"x", "text/html"

    assert documents.with_retry(flaky, sleep=waits.append)("u")[0] == 200 and waits == [1, 2]

    def fetch(url):
        if url == "bad":
            raise OSError("down")
        return (404 if url == "gone" else 200), b"<p>hi</p>", "text/html"

    got = {r["url"]: r["error"] for r in documents.scan(spark.createDataFrame([("ok",), ("bad",), ("gone",)], "url string"), fetch).collect()}
    assert got == {"ok": None, "bad": "down", "gone": "status 404"}


def test_markdown():
    assert documents.markdown("<nav>x</nav><h2>A</h2><p>b <b>c</b></p><script>no</script><li>d") == "## A\n\nb c\n\n- d"


def test_paths_and_settings():
    assert documents.resolve_path("out", "pir", "gs://b/x", lambda p: False) == "gs://b/x"
    for spelled in ("x.json", "pir/x.json", "out/pir/x.json"):
        assert documents.resolve_path("out", "pir", spelled, lambda p: False) == "out/pir/x.json"
    assert documents.Settings.from_env({"SIGLOOM_WORKERS": "8"}).workers == 8


def test_catalog(spark):
    text_ = "sources:\n- {name: a, url: 'https://x', category: c}\n- {name: b, url: 'https://y', category: c, enabled: false}\n"
    assert documents.load_catalog(spark, text_).where("enabled").count() == 1
    with pytest.raises(ValueError):
        documents.load_catalog(spark, "sources:\n- {name: a, url: 'ftp://x'}\n")
    assert documents.load_sources(spark, "sources:\n- {url: 'https://x'}\n").first()["task"] == "medium"


def test_crawl_batch(spark, tmp_path):
    page = lambda b: f"<html><body><p>{b}</p></body></html>".encode()
    fetched = spark.createDataFrame(
        [("https://x.org/a", 200, page("first"), "text/html", None), ("https://x.org/low", 200, page("dull"), "text/html", None), ("https://x.org/down", None, None, None, "down")], documents.FETCHED
    )
    sources = spark.createDataFrame([(u,) for u in ("https://x.org/a", "https://x.org/low", "https://x.org/down", "https://x.org/never")], "url string")
    verdicts = [("https://x.org/a", json.dumps({"score": 0.9, "matched_pir_ids": ["P1"], "iocs": [{"type": "ipv4", "value": "1.2.3.4", "confidence": 1, "context_snippet": "s"}]})), ("https://x.org/low", '{"score": 0.1}')]
    judge = api.replayed(spark.createDataFrame(verdicts, "url string, response string"), ["url"])
    old = spark.createDataFrame([], state.STATE)
    run = lambda s: api.crawl_batch(sources, fetched, s, judge, model(spark), "[]", "h", now())
    done = run(old)
    kinds = {r["url"]: r["kind"] for r in done.outcomes.collect()}
    assert kinds == {"https://x.org/a": "extracted", "https://x.org/low": "skipped_below_threshold", "https://x.org/down": "fetch_failed", "https://x.org/never": "fetch_failed"}
    rows = {r["url"]: r for r in done.state.collect()}
    assert set(rows) == {"https://x.org/a", "https://x.org/low"} and rows["https://x.org/a"]["iocs"][0]["value"] == "1.2.3.4"
    assert sinks.versioned(done.state, str(tmp_path / "s"), "1")
    kept = sinks.current(spark, str(tmp_path / "s"))
    again = {r["url"]: r["kind"] for r in run(kept).outcomes.collect()}
    assert again["https://x.org/a"] == "skipped_unchanged" and again["https://x.org/low"] == "skipped_unchanged"
    assert state.outcomes(done.outcomes, list(vocab.OUTCOMES)).where("n > 0").count() == 3


def test_small_is_checked(spark):
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(relational.small(spark.range(10), 10)).lower()
    assert "broadcast" not in plan(relational.small(spark.range(11), 10)).lower()


def test_containing_by_grams_equals_the_loop(spark):
    texts = spark.createDataFrame([(1, "the mail gateway"), (2, "gate"), (3, "ab"), (4, None)], "i int, t string")
    needles = spark.createDataFrame([("gate",), ("mail gate",), ("ab",), ("the",), ("zzz",)], "n string")
    rows = lambda limit: sorted((r["i"], r["n"]) for r in relational.containing(texts, "t", needles, "n", 3, limit).collect())
    assert rows(100) == rows(0) == [(1, "gate"), (1, "mail gate"), (1, "the"), (2, "gate")]


def test_schemas(spark):
    assert set(sinks.schemas()) == {"sources", "catalog", "pirs", "state", "findings"}


def test_wire_time(spark):
    assert one(spark, scalar.wire_time(F.lit(datetime(2026, 1, 2, 3, 4, 5)).cast("timestamp"))) == "2026-01-02T03:04:05.000Z"


def test_state_survives_a_crash_before_the_marker(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.current(spark, path) is None
    sinks.versioned(spark.range(2), path, "1")
    spark.range(9).write.parquet(f"{path}/v=2")  # written, but never marked as whole
    assert sinks.current(spark, path).count() == 2
    sinks.versioned(spark.range(3), path, "2")
    assert sinks.current(spark, path).count() == 3 and sinks.current(spark, path, before="2").count() == 2


def test_pattern_grammar():
    from sigloom.functions.pattern import parses

    good = [
        "[file:hashes.'SHA-256' = 'abc']",
        "[ipv4-addr:value = '1.2.3.4'] AND [domain-name:value LIKE 'a%']",
        "([a:b = 1] OR [c:d.e[*].f IN ('x','y', 3)]) FOLLOWEDBY [x:y NOT MATCHES '^a'] WITHIN 300 SECONDS",
        "[a:b = 'it\\'s'] START t'2020-01-01T00:00:00Z' STOP t'2021-01-01T00:00:00Z'",
        "[EXISTS a:b AND (c:d > 4.5 OR e:f = true)] REPEATS 3 TIMES",
    ]
    bad = [None, "", "[", "[]", "[a:b]", "a:b = 1", "[a:b = 1", "[a:b = 1]]", "[a = 'x']", "[a:b = 1] AND", "[a:b IN ()]", "[a:b = 'x'] WITHIN 3 TIMES", "(" * 5000]
    assert all(map(parses, good)) and not any(map(parses, bad))


def test_markdown_links_and_tables():
    page = '<p>a <a href="u">l</a></p><table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table><img src="i" alt="t">'
    assert documents.markdown(page) == "a [l](u)\n\n| A | B |\n| --- | --- |\n| 1 | 2 |\n\n![t](i)"


def test_pdf_text():
    import zlib

    shown = zlib.compress(rb"BT /F1 12 Tf (Hello ) Tj (W\(orld\)) Tj T* [(a) -300 (b)] TJ ET")
    assert documents.pdf_text(b"%PDF-1.4 1 0 obj <</Filter /FlateDecode>> stream\n" + shown + b"\nendstream endobj") == "Hello W(orld) a b"
    assert documents.pdf_text(b"no pdf") == ""


def test_run_log(spark):
    ticks = iter(["2026-01-01T00:00:00Z", "2026-01-01T00:00:02Z"])
    log = metrics.RunLog(lambda: next(ticks))
    event = log.start("r")
    event("llm_call_done", chars=5)
    with pytest.raises(ValueError):
        log.start("r")
    log.finish("r")
    with pytest.raises(ValueError):
        event("late")
    events = log.events(spark)
    assert metrics.durations(events).first()["seconds"] == 2.0 and metrics.fold(events).first()["llm_output_chars"] == 5.0


def test_settings_and_schemas(tmp_path):
    read = documents.Settings.from_env
    assert read({"ACTIVITY_WINDOW_DAYS": "7"}).feed_since_days == 7 and read({"ACTIVITY_WINDOW_DAYS": "7", "SIGLOOM_FEED_SINCE_DAYS": "8"}).feed_since_days == 8
    assert read({"SIGLOOM_HASH_ENABLED": "off"}).hash_enabled is False and "secret" not in repr(read({"SIGLOOM_ISSUE_TOKEN": "secret"}))
    assert read({"SIGLOOM_STORAGE": "gs", "SIGLOOM_STORAGE_BUCKET": "b", "SIGLOOM_STORAGE_PREFIX": "p/"}).root() == "gs://b/p"
    with pytest.raises(ValueError):
        read({"SIGLOOM_STORAGE": "gs"}).root()
    names = sinks.write_schemas(str(tmp_path))
    assert "assets.schema.json" in names
    port = sinks.json_schemas()["assets"]["properties"]["asset_connections"]["items"]["properties"]["port"]
    assert port == {"type": ["integer", "null"], "minimum": 0, "maximum": 65535}


def test_sources_are_checked(spark):
    with pytest.raises(ValueError, match="sources.0.task"):
        documents.load_sources(spark, "sources:\n- {url: 'https://x', task: huge}\n")


def test_needles_in_blocks(spark):
    texts = spark.createDataFrame([(1, "the mail gateway"), (2, "gate"), (3, "ab"), (4, None)], "i int, t string")
    needles = spark.createDataFrame([("gate",), ("mail gate",), ("ab",), ("the",), ("zzz",)], "n string")
    found = relational.containing(texts, "t", needles, "n", 3, 0, block_bytes=5)
    assert sorted((r["i"], r["n"]) for r in found.collect()) == [(1, "gate"), (1, "mail gate"), (1, "the"), (2, "gate")]
