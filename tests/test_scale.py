"""What keeps queries within memory and time: where work is done, and how often."""

import json
import random
import re

import pytest

from sigloom import api, vocab
from sigloom.functions import text
from sigloom.operators import graph, integrity
from sigloom.session import kept
from pyspark.sql import functions as F

NOW = "2026-06-30 12:00:00"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def packed(value: str, limit: int) -> list[str]:
    """The chunks of a text, paragraph by paragraph."""
    if len(value) <= limit:
        return [value]
    out, now, size = [], [], 0
    for p in re.split(r"\n\s*\n", value):
        if len(p) > limit or (now and size + 2 + len(p) > limit):
            out += ["\n\n".join(now)] if now else []
            now, size = [], 0
        if len(p) > limit:
            out += [p[i : i + limit] for i in range(0, len(p), limit)]
        else:
            size += len(p) + 2 * bool(now)
            now.append(p)
    return [*out, "\n\n".join(now)] if now else out


@pytest.mark.parametrize("limit", [1, 2, 5, 23])
def test_chunks_stay_in_the_jvm(spark, limit):
    """a batch of long texts in Python took memory with its rows."""
    rng = random.Random(limit)
    parts = ["a", "b", " ", "\n", "\n\n", "\n \n", "\x1c", "\xa0", " ", "\x85", "​", "\U0001f600", "\r", "x" * 7]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(50))) for _ in range(2000)] + ["", "\n\n", "\n" * 50, "a\U0001f600" * 9000, "ab\n\n" * 9000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", text.chunks("t", limit).alias("c"))
    assert "Python" not in plan(df)
    assert [r["c"] for r in df.orderBy("i").collect()] == [packed(t, limit) for t in texts]
    assert spark.range(1).select(text.chunks(F.lit(None).cast("string"), limit)).first()[0] is None


def test_model_is_asked_once(spark):
    """each table of an extraction chunked the texts and asked the model anew, with a Python worker each."""
    asked = spark.sparkContext.accumulator(0)

    def answer(prompts):
        asked.add(len(prompts))
        return prompts.map(lambda p: '{"entities": [{"local_id": "a", "type": "malware", "name": "x"}]}')

    names = []
    keep = lambda df, name: (names.append(name), kept(df, name))[1]
    sources = spark.createDataFrame([("u1",), ("u2",)], "url string")
    fetched = spark.createDataFrame([(u, bytearray(b"text"), "text/plain", None) for u in ("u1", "u2")], "url string, content binary, content_type string, error string")
    old = spark.createDataFrame(
        [],
        "url string, first_seen string, last_seen string, content_sha256 string, bundle_path string, relevance struct<decision:string,score:double,matched_pir_ids:array<string>,"
        "rationale:string,pir_set_hash:string>, iocs array<struct<type:string,value:string,confidence:double,context_snippet:string>>",
    )
    model = lambda prompts: prompts.withColumn("response", F.pandas_udf(answer, "string")("prompt"))
    done = api.crawl_batch(sources, fetched, old, None, model, "[]", "h", F.lit(NOW).cast("timestamp"), keep=keep)
    assert [(r["url"], r["kind"]) for r in done.outcomes.orderBy("url").collect()] == [("u1", "extracted"), ("u2", "extracted")]
    assert asked.value == 2
    assert "responses" in names and not {"accounts", "asset_edges", "raw_entities"} & set(names)


def test_findings_are_counted_before_they_meet_sections(spark):
    """the join by section put all findings of one section into one task."""
    found = spark.range(0, 1000, 1, 4).selectExpr("if(id % 10 = 0, 'b', 'a') section", "if(id % 4 = 0, 'warning', 'error') severity")
    found = found.unionByName(spark.createDataFrame([("a", "odd"), ("z", "error"), (None, "error")], "section string, severity string"))
    sections = spark.createDataFrame([("a",), ("b",), ("none",)], "section string")
    got = integrity.totals(found, sections)
    steps = plan(got)
    assert "count_if" not in steps.split("Join")[0]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        [("a", 700, 200, 0, "FAIL"), ("b", 50, 50, 0, "FAIL"), ("none", 0, 0, 0, "PASS"), (None, 750, 250, 0, "FAIL")], key=repr
    )


def test_bundles_are_checked_within_their_rows(spark, monkeypatch):
    """F8: every rule parsed all bundles anew, and ends met nodes by shuffles; the joins are left for very long texts."""
    nodes = [{"type": "threat-actor", "id": "threat-actor--1"}, {"type": "malware", "id": "m", "kill_chain_phases": [{"kill_chain_name": "x"}, {}]}, {"type": "tool", "id": "m"}, {"type": 7}, {"id": "m"}, 1]
    edges = [{"type": "relationship", "relationship_type": r, "source_ref": s, "target_ref": t} for r in ("uses", "impersonates") for s in ("m", "campaign--9") for t in (None, "", "threat-actor--1", "q")]
    people = [{"type": vocab.IDENTITY_NODE, "id": "i", "identity_id": i} for i in ("a", "b", None)]
    rows = [("p", json.dumps({"type": "bundle", "objects": nodes + edges + people})), ("q", json.dumps({"type": "b", "objects": edges})), ("r", "{"), ("s", "[]"), ("t", '{"type":"bundle","objects":3}')]
    texts = spark.createDataFrame(rows, "path string, value string")
    known = spark.createDataFrame([("a",), (None,)], "id string")
    found = api.validate_bundle(texts, known_identities=known)
    assert "Exchange hashpartitioning(bundle_id" not in plan(found) and plan(api.validate_bundle(texts)).count("Exchange") == 0
    monkeypatch.setattr(api, "LONG_BUNDLE", -1)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, api.validate_bundle(texts, known_identities=known).collect()))


def test_enrichment_stays_within_its_row(spark, monkeypatch):
    """objects were unfolded and shuffled twice, and whole texts once, to add a few labels."""
    objects = [{"type": "threat-actor", "name": " G  One", "aliases": ["two", "none"], "labels": ["b", "x"], "n": 1.5}, {"type": "intrusion-set", "name": "TWO"}, {"type": "malware", "name": "two"}, {"type": "threat-actor", "aliases": ["two"]}]
    rows = [("p", json.dumps({"type": "bundle", "z": [1], "objects": objects})), ("q", "{"), ("r", None), ("s", '{"objects":[{"type":"tool","name":"two"}],  "a":1}'), ("t", '{"objects":3}')]
    texts = spark.createDataFrame(rows, "path string, value string")
    taxonomy = spark.createDataFrame([("g one", "x", 0), ("g one", "y", 1), ("two", "y", 2), ("two", "z", 3), (None, "n", 4)], "group_norm string, tag string, ord int")
    read = lambda df: {r["path"]: (json.loads(r["value"]) if r["n_enriched"] else r["value"], r["n_enriched"]) for r in df.collect()}
    done = api.enrich_bundle_texts(texts, taxonomy)
    assert "Exchange" not in plan(done) and "Python" not in plan(done)
    got = read(done)
    assert got["p"][1] == 2 and [o.get("labels") for o in got["p"][0]["objects"]] == [["b", "x", "y", "z"], ["y", "z"], None, None]
    monkeypatch.setattr(graph, "FEW_GROUPS", 0)
    assert got == read(api.enrich_bundle_texts(texts, taxonomy))
