"""Sinks: bundles, state, candidates, reports, metrics, tables for people."""

from __future__ import annotations

import json
import os
import tempfile

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vocab
from .functions import scalar, text


def bundle_files(bundles: DataFrame, path: str, url: str = "url", parts: int | None = None) -> None:
    """One JSON text per row, below a folder per slug prefix; keyed by the URL's hash, as slugs can collide."""
    name = F.concat_ws("_", F.lit("bundle"), text.slug(url), F.substring(scalar.sha256(url), 1, 12))
    out = bundles.select(name.alias("name"), "bundle")
    (out.repartition(parts) if parts else out).write.mode("overwrite").parquet(path)


def each_bundle(bundles: DataFrame, write: Callable[[str, str], None], url: str = "url") -> None:
    """Hand each bundle to ``write(name, text)`` on the executors: exact files, object stores, other hooks."""

    def run(rows) -> None:
        for r in rows:
            write(r["name"], r["bundle"])

    bundles.select(F.concat(F.lit("bundle_"), text.slug(url), F.lit(".json")).alias("name"), "bundle").foreachPartition(run)


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _hadoop(spark, path)
    return fs.exists(at)


def listing(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, at = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def versioned(df: DataFrame, path: str, version: str) -> str:
    """Replace a keyed table: a new version beside the old ones, then a marker that it is whole.

    Nothing that readers use is ever replaced: a crash before the marker leaves the version before.
    Versions sort by their names; the largest one with a marker is the current one.
    """
    spark = df.sparkSession
    target = f"{path}/v={version}"
    df.write.mode("overwrite").parquet(target)
    fs, marker = _hadoop(spark, f"{path}/_whole/{version}")
    fs.create(marker, True).close()
    return target


def current(spark: SparkSession, path: str, before: str | None = None) -> DataFrame | None:
    """The table that :func:`versioned` wrote last (of the versions before ``before``); None if there is none."""
    whole = [v for v in listing(spark, f"{path}/_whole") if before is None or v < before]
    return spark.read.parquet(f"{path}/v={whole[-1]}") if whole else None


def file_writer(folder: str) -> Callable[[str, str], None]:
    """A ``write`` for :func:`each_bundle`: files in a folder that all executors share, each replaced as a whole."""

    def write(name: str, body: str) -> None:
        os.makedirs(folder, exist_ok=True)
        with tempfile.NamedTemporaryFile("w", dir=folder, delete=False, encoding="utf-8", suffix=".part") as f:
            f.write(body)
        os.replace(f.name, os.path.join(folder, name))

    return write


def candidate_envelope(candidates: DataFrame, version: str = "1.0.0") -> DataFrame:
    """One JSON text with the ranked candidates, which a limit has bounded."""
    row = F.struct("ord_out", *(c for c in candidates.columns if c != "ord_out"))
    return candidates.agg(F.to_json(F.struct(F.lit(version).alias("schema_version"), F.array_sort(F.collect_list(row)).alias("candidates"))).alias("json"))


def state_json(state: DataFrame) -> DataFrame:
    """The state as one row per URL, each a JSON text (``url`` and ``entry``); files stay splittable."""
    return state.select("url", F.to_json(F.struct(*(c for c in state.columns if c != "url"))).alias("entry"))


def report(totals: list, findings: list, title: str = "Validation report", at: str = "") -> str:
    """Markdown from the rows of ``integrity.totals`` and the (bounded) findings to show."""
    everything = next((r for r in totals if r["section"] is None), None)
    lines = [f"# {title}", "", f"Generated: {at}" if at else "", "", "| section | errors | warnings | info | verdict |", "|-|-|-|-|-|"]
    for r in sorted((r for r in totals if r["section"] is not None), key=lambda r: r["section"]):
        lines.append(f"| {r['section']} | {r['n_error']} | {r['n_warning']} | {r['n_info']} | {r['verdict']} |")
    if everything is not None:
        lines += ["", f"**{everything['verdict']}**: {everything['n_error']} errors, {everything['n_warning']} warnings, {everything['n_info']} notes"]
    escape = lambda s: str(s).replace("|", "\\|").replace("\n", " ")
    for section in sorted({f["section"] for f in findings}):
        lines += ["", f"## {section}", "", "| severity | code | location | message |", "|-|-|-|-|"]
        lines += [f"| {f['severity']} | {f['code']} | {escape(f['location'])} | {escape(f['message'])} |" for f in findings if f["section"] == section]
    return "\n".join(x for x in lines) + "\n"


def issue(title: str, body: str, post: Callable[[dict], dict], title_limit: int = 256, body_limit: int = 65_536) -> dict:
    """A report handed to an issue tracker through ``post``, within its limits."""
    cut = lambda s, n: s if len(s) <= n else s[: n - 25] + "\n\n[truncated to the limit]"[:25]
    return post({"title": cut(title, title_limit), "body": cut(body, body_limit)})


def match_table(matches: DataFrame, width: int = 40) -> DataFrame:
    """Fixed-width lines of search results."""
    cell = lambda c: F.rpad(F.substring(F.coalesce(F.col(c).cast("string"), F.lit("")), 1, width), width, " ")
    return matches.select(F.concat_ws("  ", *(cell(c) for c in ("type", "value", "tlp", "url"))).alias("line"))


def match_json(matches: DataFrame) -> DataFrame:
    """One row: the search results as a JSON list, in order of URL and place. Results of one search, bounded by it."""
    row = F.struct(*(c for c in matches.columns))
    return matches.agg(F.coalesce(F.to_json(F.array_sort(F.collect_list(row))), F.lit("[]")).alias("json"))


def metrics_json(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", F.to_json(F.struct(*runs.columns)).alias("json"))


def batch_json(totals: DataFrame, runs: DataFrame) -> DataFrame:
    """One JSON text for a batch: its totals, and how many runs there are; the runs are rows of :func:`metrics_json`."""
    return totals.select(F.to_json(F.struct(F.lit("batch").alias("kind"), *totals.columns)).alias("json"))


def report_lines(findings: DataFrame) -> DataFrame:
    """(section, line): every finding as a row of its section's Markdown table, sorted; for a report of any size."""
    cells = [F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")) for c in ("severity", "code", "location", "message")]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    return findings.orderBy("section", "severity", "code", "location").select("section", line.alias("line"))


def hash_cache_json(cache: DataFrame) -> DataFrame:
    """The hash cache as one row per URL, each a JSON text (``url`` and ``entry``); ``documents.load_hash_cache`` reads it."""
    return cache.select("url", F.to_json(F.struct(*(c for c in cache.columns if c != "url"))).alias("entry"))


def schemas() -> dict[str, str]:
    """The engine's table schemas as JSON."""
    from pyspark.sql.types import StructType

    from .operators.integrity import FINDING
    from .operators.state import STATE
    from .sources.documents import CATALOG, PIRS, SOURCES

    named = {"sources": SOURCES, "catalog": CATALOG, "pirs": PIRS, "state": STATE, "findings": FINDING}
    return {k: StructType.fromDDL(v).json() for k, v in named.items()}


_JSON_TYPES = {"string": "string", "double": "number", "float": "number", "integer": "integer", "long": "integer", "boolean": "boolean", "date": "string"}


def _json_schema(kind) -> dict:
    from pyspark.sql import types as T

    if isinstance(kind, T.StructType):
        return {"type": "object", "properties": {f.name: _json_schema(f.dataType) for f in kind.fields}}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": _json_schema(kind.elementType)}
    if isinstance(kind, T.MapType):
        return {"type": "object", "additionalProperties": _json_schema(kind.valueType)}
    out = {"type": _JSON_TYPES.get(kind.typeName(), "string")}
    return {**out, "format": "date"} if isinstance(kind, T.DateType) else out


def _rule_schema(rule) -> dict:
    kind = {"list": "array", "date": "string"}.get(rule.kind, rule.kind)
    out: dict = {"type": [kind, "null"] if rule.null else kind}
    for key, value in (("minLength", rule.least or None), ("minimum", rule.low), ("maximum", rule.high), ("exclusiveMinimum", rule.above)):
        if value is not None:
            out[key] = value
    if rule.words:
        out["enum"] = list(rule.words)
    if rule.kind == "date":
        out["format"] = "date"
    return out


def json_schemas() -> dict[str, dict]:
    """JSON Schemas of the configuration documents (from their field rules) and of the engine's tables."""
    from pyspark.sql.types import StructType

    from .operators.fields import DOCUMENTS
    from .operators.integrity import FINDING
    from .operators.state import STATE
    from .sources.documents import CATALOG

    out = {k: _json_schema(StructType.fromDDL(v)) for k, v in {"catalog": CATALOG, "state": STATE, "findings": FINDING}.items()}
    for name, document in DOCUMENTS.items():
        root: dict = {"type": "object", "properties": {}}
        for section in document.sections:
            at = root
            for step in section.steps:
                name_, many = step.removesuffix("[]"), step.endswith("[]")
                spec = at["properties"].setdefault(name_, {})
                if many:
                    spec |= {"type": "array"}
                    at = spec.setdefault("items", {"type": "object", "properties": {}})
                else:
                    spec |= {"type": "object"}
                    spec.setdefault("properties", {})
                    at = spec
            for field, rule in section.rules.items():
                at["properties"][field] = _rule_schema(rule) | at["properties"].get(field, {})
            need = [f for f, r in section.rules.items() if r.required]
            if need:
                at["required"] = need
            if section.closed:
                at["additionalProperties"] = False
        out[name] = {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": name, **root}
    return out


def write_schemas(folder: str) -> list[str]:
    """Each schema as a file of its own."""
    write = file_writer(folder)
    for name, schema in json_schemas().items():
        write(f"{name}.schema.json", json.dumps(schema, indent=2, sort_keys=True) + "\n")
    return sorted(os.listdir(folder))


LEVELS = vocab.TLP_LEVELS
