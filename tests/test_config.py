"""Configuration documents and feed types."""

import json
from datetime import date

import pytest

from sigloom.operators import integrity
from sigloom.sources import config, documents


def test_windows():
    assert config.resolve_window(date(2026, 6, 30)) == (date(2026, 5, 31), date(2026, 6, 30))
    for bad in ({"days": 0}, {"start": date(2026, 7, 1)}):
        with pytest.raises(ValueError):
            config.resolve_window(date(2026, 6, 30), **bad)
    assert config.parse_date(" 2026-01-02 ") == date(2026, 1, 2)


def test_taxonomy_sync(tmp_path):
    tree = {"actor_categories": {"state": {"a": {}, "b": {}}}, "geography_threat_map": {"x": 1}}
    cache = str(tmp_path / "t" / "cache.json")
    with pytest.raises(ValueError):
        config.sync_taxonomy(lambda: "{}", cache, "now")
    first = config.sync_taxonomy(lambda: json.dumps(tree), cache, "now")
    assert first["_metadata"]["synced_at"] == "now" and config.taxonomy_counts(first) == {"state": 2, "geographies": 1}

    def down():
        raise OSError

    assert config.sync_taxonomy(down, cache, "later") == first


def test_schema_drift_of_documents(spark):
    a = {"required": ["x"], "properties": {"x": {"type": "integer"}, "y": {"anyOf": [{"type": "string", "format": "date"}, {"type": "null"}]}, "z": {"$ref": "#/$defs/Z"}}, "$defs": {"Z": {"type": "object", "properties": {"q": {"type": "string"}}}}}
    b = {"properties": {"x": {"type": "number"}, "y": {"type": ["string", "null"]}, "z": {"type": "array"}}, "additionalProperties": False}
    fa, fb = config.schema_fields(spark, a), config.schema_fields(spark, b)
    assert integrity.schema_drift(fa, fa).count() == 0
    got = {(r["field"], r["rule"]) for r in integrity.schema_drift(fa, fb).collect()}
    assert {("x", "required_differs"), ("y", "format_differs"), ("z", "types_disjoint"), ("Z.q", "missing_in_consumer")} <= got and ("x", "types_disjoint") not in got


def test_typed_sources(spark):
    src = spark.createDataFrame([("a", None), ("b", None), ("c", "rss"), ("d", None)], "url string, feed_type string")
    probed = spark.createDataFrame([("a", 200, b"", "application/atom+xml", None), ("b", None, None, None, "down"), ("d", 200, b"<rss>", "text/xml", None)], documents.FETCHED.replace("status int, content binary", "status int, content binary"))
    assert {r["url"]: r["feed_type"] for r in config.typed_sources(src, probed).collect()} == {"a": "atom", "b": "html", "c": "rss", "d": "rss"}
