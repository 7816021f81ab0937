"""Configuration documents, read and checked on the driver: taxonomy snapshots, JSON schemas, date windows."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from collections.abc import Callable
from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar

REQUIRED = ("actor_categories", "geography_threat_map")


def resolve_window(today: date, start: date | None = None, end: date | None = None, days: int = 30) -> tuple[date, date]:
    """The dates of a search: until today and ``days`` back unless given."""
    if days <= 0:
        raise ValueError("days must be positive")
    last = end or today
    first = start or last - timedelta(days=days)
    if first > last:
        raise ValueError("the window starts after its end")
    return first, last


def parse_date(raw: str) -> date:
    return date.fromisoformat(raw.strip())


# --- taxonomy ---------------------------------------------------------------------------------


def check_taxonomy(tree: object) -> dict:
    """The tree, if it is an object with the parts that it must have."""
    if not isinstance(tree, dict) or not set(REQUIRED) <= tree.keys():
        raise ValueError(f"a taxonomy needs {', '.join(REQUIRED)}")
    return tree


def taxonomy_counts(tree: dict) -> dict[str, int]:
    """Entries per actor category, and geographies."""
    categories = {k: len(v) for k, v in tree["actor_categories"].items() if isinstance(v, dict)}
    return {**categories, "geographies": len(tree["geography_threat_map"])}


def sync_taxonomy(read: Callable[[], str], cache: str, now: str) -> dict:
    """Copy a snapshot with its origin stamped into ``cache``; what is there stays if the source fails."""
    try:
        raw = read()
        tree = check_taxonomy(json.loads(raw))
    except (OSError, ValueError):
        if os.path.exists(cache):
            return json.loads(Path(cache).read_text(encoding="utf-8"))
        raise
    stamped = {**tree, "_metadata": {**tree.get("_metadata", {}), "synced_at": now, "source_sha256": hashlib.sha256(raw.encode()).hexdigest()}}
    folder = os.path.dirname(os.path.abspath(cache))
    os.makedirs(folder, exist_ok=True)
    with tempfile.NamedTemporaryFile("w", dir=folder, delete=False, encoding="utf-8") as f:
        json.dump(stamped, f, ensure_ascii=False)
    os.replace(f.name, cache)
    return stamped


# --- JSON schemas -----------------------------------------------------------------------------


def _types(spec: dict, root: dict) -> set[str]:
    if "$ref" in spec:
        return _types(root.get("$defs", {}).get(spec["$ref"].rsplit("/", 1)[-1], {}), root)
    out: set[str] = set()
    for part in (*spec.get("anyOf", ()), *spec.get("oneOf", ()), *spec.get("allOf", ())):
        out |= _types(part, root)
    kind = spec.get("type")
    return out | (set(kind) if isinstance(kind, list) else {kind} if kind else set())


def _format(spec: dict) -> str | None:
    if "format" in spec:
        return spec["format"]
    return next((f for p in (*spec.get("anyOf", ()), *spec.get("oneOf", ())) if (f := _format(p))), None)


def schema_fields(spark: SparkSession, schema: dict) -> DataFrame:
    """(field, types, format, required, extra) of a JSON schema and its definitions, for ``integrity.schema_drift``.

    ``null`` isn't a type of its own, and an integer counts as a number too.
    """
    rows = []
    for owner, spec in {"": schema, **schema.get("$defs", {})}.items():
        need = set(spec.get("required", ()))
        for name, own in spec.get("properties", {}).items():
            types = _types(own, schema) - {"null"}
            if "integer" in types:
                types |= {"number"}
            rows.append((f"{owner}.{name}".lstrip("."), sorted(types), _format(own), name in need, bool(spec.get("additionalProperties", True))))
    return spark.createDataFrame(rows, "field string, types array<string>, format string, required boolean, extra boolean")


# --- feed types -------------------------------------------------------------------------------


def typed_sources(sources: DataFrame, probed: DataFrame | None = None) -> DataFrame:
    """Sources with ``feed_type`` filled in from a probe (url, content_type, content, error); html where it failed."""
    if probed is None:
        return sources.withColumn("feed_type", F.coalesce("feed_type", F.lit("html")))
    p = probed.select("url", F.col("content_type").alias("_type"), F.col("content").alias("_content"), F.col("error").alias("_error"))
    found = scalar.feed_type(F.col("feed_type"), F.col("_type"), F.col("_content"))
    return sources.join(p, "url", "left").withColumn(
        "feed_type", F.when(F.col("_error").isNotNull(), F.coalesce("feed_type", F.lit("html"))).otherwise(found)
    ).drop("_type", "_content", "_error")


def probe(url: str, timeout: float = 30.0, agent: str = "sigloom/0.1") -> tuple[int, bytes, str]:
    """A HEAD request, or the first bytes by GET where HEAD isn't served; for ``documents.scan``."""
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    headers = {"User-Agent": agent}
    try:
        with urlopen(Request(url, method="HEAD", headers=headers), timeout=timeout) as r:  # noqa: S310
            return r.status, b"", r.headers.get("Content-Type", "")
    except HTTPError as e:
        if e.code != 405 and e.code < 500:
            raise
    with urlopen(Request(url, headers={**headers, "Range": "bytes=0-2047"}), timeout=timeout) as r:  # noqa: S310
        return r.status, r.read(2048), r.headers.get("Content-Type", "")
