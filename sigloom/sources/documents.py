"""Documents: fetching through an injected function, conversion to text, configuration files."""

from __future__ import annotations

import re
import time
import zlib
from collections.abc import Callable, Iterator
import dataclasses
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..operators import fields

FETCHED = "url string, status int, content binary, content_type string, error string"
Fetch = Callable[[str], tuple[int, bytes, str]]


def with_retry(fetch: Fetch, waits: tuple[float, ...] = (1, 2, 4), sleep: Callable[[float], None] = time.sleep) -> Fetch:
    """``fetch``, tried again after each wait; the last error is raised."""

    def run(url: str) -> tuple[int, bytes, str]:
        for wait in (*waits, None):
            try:
                return fetch(url)
            except Exception:
                if wait is None:
                    raise
                sleep(wait)
        raise AssertionError

    return run


def http_get(url: str, timeout: float = 30.0, agent: str = "sigloom/0.1") -> tuple[int, bytes, str]:
    """GET with redirects; statuses of 400 and above raise."""
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers={"User-Agent": agent}), timeout=timeout) as r:  # noqa: S310
        return r.status, r.read(), r.headers.get("Content-Type", "")


def scan(urls: DataFrame, fetch: Fetch = http_get, parallel: int | None = None, url: str = "url") -> DataFrame:
    """One row per URL with its content or its error; ``parallel`` caps concurrent connections.

    External: write the result before using it twice, as a plan that is run again fetches again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for u in batch["url"]:
                try:
                    status, content, kind = fetch(u)
                    rows.append((u, status, content, kind, None if status < 400 else f"status {status}"))
                except Exception as e:  # a failed URL is a row, not a failed job
                    rows.append((u, None, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["url", "status", "content", "content_type", "error"]).astype({"status": "Int32"})

    todo = urls.select(F.col(url).alias("url"))
    return (todo.repartition(parallel) if parallel else todo).mapInPandas(run, FETCHED)


def replay(urls: DataFrame, responses: DataFrame) -> DataFrame:
    """As :func:`scan`, from a table of responses; URLs that it lacks are errors."""
    found = urls.select("url").join(responses, "url", "left")
    return found.withColumn("error", F.when(F.col("content").isNull(), F.coalesce("error", F.lit("no response"))).otherwise(F.col("error")))


class _Text(HTMLParser):
    _SKIP = frozenset("script style nav header footer aside form noscript template svg".split())
    _BREAK = frozenset("p div section article ul ol li table tr blockquote pre br h1 h2 h3 h4 h5 h6".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0
        self.links: list[str] = []
        self.rows: list[int] = []  # cells of the current row, and rows before it, of each open table
        self.cells: list[int] = []

    def handle_starttag(self, tag, attrs):
        if tag in self._SKIP:
            self.skip += 1
        elif self.skip:
            return
        elif tag == "a":
            href = dict(attrs).get("href") or ""
            self.links.append(href)
            if href:
                self.out.append("[")
        elif tag == "img":
            got = dict(attrs)
            if got.get("src"):
                self.out.append(f"![{got.get('alt') or ''}]({got['src']})")
        elif tag == "table":
            self.rows.append(0)
            self.cells.append(0)
            self.out.append("\n\n")
        elif tag == "tr" and self.rows:
            self.cells[-1] = 0
            self.out.append("\0" if self.rows[-1] else "")
        elif tag in ("td", "th") and self.rows:
            self.cells[-1] += 1
            self.out.append("| ")
        elif tag in self._BREAK:
            self.out.append("\n\n" + ("#" * int(tag[1]) + " " if tag[0] == "h" and tag[1:].isdigit() else "- " if tag == "li" else ""))

    def handle_endtag(self, tag):
        if tag in self._SKIP:
            self.skip = max(0, self.skip - 1)
        elif self.skip:
            return
        elif tag == "a" and self.links:
            href = self.links.pop()
            if href:
                self.out.append(f"]({href})")
        elif tag in ("td", "th") and self.rows:
            self.out.append(" ")
        elif tag == "tr" and self.rows:
            self.out.append("|" if self.cells[-1] else "")
            if not self.rows[-1] and self.cells[-1]:
                self.out.append("\0" + "| --- " * self.cells[-1] + "|")
            self.rows[-1] += 1
        elif tag == "table" and self.rows:
            self.rows.pop()
            self.cells.pop()
            self.out.append("\n\n")
        elif tag in self._BREAK:
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data.replace("\0", ""))


def markdown(html: str) -> str:
    """A plain rendering of a page: headings, list items, links, images and tables."""
    parser = _Text()
    parser.feed(html)
    parser.close()
    blocks = ("\n".join(" ".join(line.split()) for line in b.split("\0")).strip() for b in "".join(parser.out).split("\n\n"))
    return "\n\n".join(b for b in blocks if b)


_STREAM = re.compile(rb"<<(.*?)>>\s*stream\r?\n(.*?)\r?\nendstream", re.S)
_SHOWN = re.compile(rb"\((?:[^()\\]|\\.)*\)|<[0-9A-Fa-f\s]*>|-?\d+(?:\.\d+)?|\[|\]|T[Jj*dDm]|ET|'|\"", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"", b"f": b""}


def pdf_text(content: bytes) -> str:
    """The text of a PDF whose pages are plain or deflated streams with fonts of one byte a character.

    Documents that are encrypted, scanned, or use other fonts give nothing or part; pass a converter
    of your own to :func:`articles` for these.
    """
    out: list[str] = []
    for head, body in _STREAM.findall(content):
        if b"FlateDecode" in head:
            try:
                body = zlib.decompressobj().decompress(body)
            except zlib.error:
                continue
        if b"BT" not in body or (b"Tj" not in body and b"TJ" not in body):
            continue
        held: list[str] = []
        for m in _SHOWN.finditer(body):
            t = m.group()
            if t[:1] == b"(":
                raw = re.sub(rb"\\([0-7]{1,3}|.)", lambda e: bytes([int(e[1], 8) & 255]) if e[1].isdigit() else _ESCAPES.get(e[1], e[1]), t[1:-1], flags=re.S)
                held.append(raw.decode("cp1252", "replace"))
            elif t[:1] == b"<":
                digits = re.sub(rb"\s", b"", t[1:-1])
                held.append(bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()).decode("cp1252", "replace"))
            elif t in (b"Tj", b"TJ", b"'", b'"'):
                out += held
                held = []
            elif t in (b"T*", b"Td", b"TD", b"Tm", b"ET"):
                out.append("\n" if t != b"ET" else "\n\n")
                held = []
            elif t[:1] not in b"[]" and float(t) < -200 and held:
                held.append(" ")  # a wide gap between two runs of a line
    text_ = "".join(out)
    return "\n\n".join(" ".join(b.split()) for b in re.split(r"\n\s*\n", text_) if b.strip())


@F.pandas_udf(T.StringType())
def to_markdown(pages: pd.Series) -> pd.Series:
    return pages.map(lambda h: None if h is None else markdown(h))


def converted(pdf: Callable[[bytes], str]):
    """The text of PDF contents by ``pdf``; one that it fails on has none."""

    def run(contents: pd.Series) -> pd.Series:
        def one(content):
            try:
                return None if content is None else pdf(bytes(content))
            except Exception:  # a broken file is an empty text, and thus rejected, not a failed job
                return ""

        return contents.map(one)

    return F.pandas_udf(run, T.StringType())


def articles(fetched: DataFrame, max_chars: int | Column = 30_000, skip_boilerplate: bool = True, pdf: Callable[[bytes], str] = pdf_text) -> DataFrame:
    """(url, text): pages as Markdown, PDF as text, other content decoded; of pages, what precedes the first heading is skipped; clipped.

    ``max_chars`` may be a column of ``fetched``.
    """
    kind = F.lower(F.coalesce("content_type", F.lit("")))
    page = F.contains(kind, F.lit("html"))
    paper = F.contains(kind, F.lit("pdf")) | F.lower(F.split_part("url", F.lit("?"), F.lit(1))).endswith(".pdf")
    body = F.decode("content", "utf-8")
    text_ = F.when(page, to_markdown(F.when(page, body))).when(paper, converted(pdf)(F.when(paper & ~page, F.col("content")))).otherwise(body)
    most = max_chars if isinstance(max_chars, Column) else F.lit(max_chars)
    df = fetched.where("error is null").select("url", page.alias("_page"), most.alias("_most"), F.coalesce(text_, F.lit("")).alias("text"))
    if skip_boilerplate:
        start = F.when(F.col("_page"), text.article_start("text")).otherwise(0)
        df = df.withColumn("text", F.substring("text", start + 1, F.length("text")))
    return df.select("url", F.substring("text", F.lit(1), F.col("_most")).alias("text")).where(text.strip("text") != "")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, value): whole files below any path that Spark can read, object stores included."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """(url, content, content_type, error): files as fetched documents, their kind by their name."""
    name = F.lower(F.col("path"))
    kind = F.when(name.rlike(r"\.html?$"), "text/html").when(name.endswith(".pdf"), "application/pdf").otherwise("text/plain")
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("url"), "content", kind.alias("content_type"), F.lit(None).cast("string").alias("error"))


# --- configuration and requirement sets -------------------------------------------------------

SOURCES = "url string, label string, task string, max_chars int, pir_ids array<string>, feed_type string"
CATALOG = "name string, url string, type string, category string, enabled boolean, max_entries int"
PIRS = (
    "pir_id string, threat_actor_tags array<string>, asset_weight_rules array<struct<tag:string,criticality_multiplier:double>>, valid_from date, "
    "valid_until date, organizational_scope string, description string, intelligence_level string, notable_groups array<string>, collection_focus array<string>, "
    "prioritized_actors array<struct<actor_id:string,name:string,aliases:array<string>,likelihood:double>>"
)


def _rows(spark: SparkSession, items: list[dict], schema: str, defaults: dict) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(i.get(n, defaults.get(n)) for n in names) for i in items], schema)


def load_sources(spark: SparkSession, yaml_text: str) -> DataFrame:
    """The sources of a list; one that breaks a field rule (see ``fields``) is an error that names all of them."""
    import json

    import yaml

    doc = yaml.safe_load(yaml_text) or {}
    found = fields.check(spark.createDataFrame([("sources", json.dumps(doc, default=str))], "path string, value string"), "sources").collect()
    if found:
        raise ValueError("; ".join(sorted(f"{r['location']}: {r['message']}" for r in found)))
    return _rows(spark, doc.get("sources") or [], SOURCES, {"task": "medium", "max_chars": 30_000, "pir_ids": []})


def enabled(catalog: DataFrame) -> DataFrame:
    """The sources of a catalog that are in use."""
    return catalog.where(F.coalesce("enabled", F.lit(True)))


def load_catalog(spark: SparkSession, yaml_text: str) -> DataFrame:
    """Catalog rows; a URL that isn't http(s) is an error."""
    import yaml

    items = (yaml.safe_load(yaml_text) or {}).get("sources") or []
    for i in items:
        if not str(i.get("url", "")).startswith(("http://", "https://")):
            raise ValueError(f"not an http(s) URL: {i.get('url')}")
    return _rows(spark, items, CATALOG, {"type": "rss", "enabled": True, "max_entries": 50})


def load_pirs(raw: DataFrame, value: str = "value") -> DataFrame:
    """(pir_set_hash, pos, requirement columns) from whole JSON texts; texts without ``pirs`` (bare lists too) give no rows."""
    pirs = T.ArrayType(T.StructType.fromDDL(PIRS))
    envelope = F.from_json(value, T.StructType([T.StructField("schema_version", T.StringType()), T.StructField("pirs", pirs)]))
    return raw.select(F.sha2(value, 256).alias("pir_set_hash"), F.posexplode(envelope["pirs"]).alias("pos", "p")).select("pir_set_hash", "pos", "p.*")


def load_state(raw: DataFrame, value: str = "value") -> DataFrame:
    """The state table from its JSON text of version 1; entries without indicators have an empty list."""
    entry = (
        "first_seen:string,last_seen:string,content_sha256:string,bundle_path:string,relevance:struct<decision:string,score:double,"
        "matched_pir_ids:array<string>,rationale:string,pir_set_hash:string>,iocs:array<struct<type:string,value:string,confidence:double,context_snippet:string>>"
    )
    doc = F.from_json(value, f"struct<version:int,entries:map<string,struct<{entry}>>>")
    rows = raw.select(doc.alias("d")).where("d.version = 1").select(F.explode("d.entries").alias("url", "e")).select("url", "e.*")
    return rows.withColumn("iocs", F.coalesce("iocs", F.expr("cast(array() as array<struct<type:string,value:string,confidence:double,context_snippet:string>>)")))


def load_hash_cache(raw: DataFrame, value: str = "value") -> DataFrame:
    """(url, sha256, fetched_at, status) from a cache's JSON text, an object of entries by URL; what can't be read is empty."""
    entries = F.from_json(value, "map<string,struct<sha256:string,fetched_at:string,status:string>>")
    return raw.select(F.explode(entries).alias("url", "e")).select("url", "e.sha256", "e.fetched_at", "e.status")


def pir_errors(raw: DataFrame, path: str = "path", value: str = "value") -> DataFrame:
    """Requirement documents that :func:`load_pirs` has no rows of: findings, see ``fields.check_pir_envelope``."""
    return fields.check_pir_envelope(raw, path, value)


def load_bundles(raw: DataFrame, path: str = "path", value: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Heads (bundle_id, type), nodes and edges of bundles from their JSON texts; ``bundle_id`` is the path."""
    parsed = raw.select(F.col(path).alias("bundle_id"), F.try_parse_json(value).alias("v"))
    heads = parsed.select("bundle_id", F.try_variant_get("v", "$.type", "string").alias("type"))
    objects = parsed.select("bundle_id", F.posexplode(F.try_variant_get("v", "$.objects", "array<variant>")).alias("pos", "o"))
    field = lambda name, kind="string": F.try_variant_get("o", f"$.{name}", kind).alias(name)
    typed = objects.withColumn("type", F.try_variant_get("o", "$.type", "string"))
    phases = F.from_json(F.to_json(F.try_variant_get("o", "$.kill_chain_phases", "variant")), "array<struct<kill_chain_name:string,phase_name:string>>")
    nodes = typed.where("type <> 'relationship'").select(
        "bundle_id", "pos", field("id"), "type", field("name"), field("identity_id"), phases.alias("kill_chain_phases"), F.to_json("o").alias("json")
    )
    edges = typed.where("type = 'relationship'").select(
        "bundle_id", "pos", field("id"), field("relationship_type"), field("source_ref"), field("target_ref"), field("confidence", "int"), field("description")
    )
    return heads, nodes, edges


def markings(raw: DataFrame, path: str = "path", value: str = "value") -> DataFrame:
    """(bundle_path, marking_ref): one row per marking of a bundle or of its objects."""
    own = "array<string>"
    doc = F.from_json(value, f"struct<object_marking_refs:{own},objects:array<struct<object_marking_refs:{own}>>>")
    none = F.array().cast(own)
    refs = F.concat(F.coalesce(doc["object_marking_refs"], none), F.coalesce(F.flatten(F.filter(F.transform(doc["objects"], lambda o: o["object_marking_refs"]), lambda r: r.isNotNull())), none))
    return raw.select(F.col(path).alias("bundle_path"), F.explode(refs).alias("marking_ref"))


# --- places -----------------------------------------------------------------------------------

CATEGORIES = ("pir", "assets", "stix", "plans", "crawl_state")


def resolve_path(root: str, category: str, value: str, exists: Callable[[str], bool]) -> str:
    """A reference as a path: a URI or an existing path as it is, else a key below ``root/category``."""
    if category not in CATEGORIES:
        raise ValueError(f"unknown category {category}")
    if "://" in value or exists(value):
        return value
    return f"{root.rstrip('/')}/{category}/{storage_key(root, category, value)}"


def storage_key(root: str, category: str, value: str) -> str:
    """A file's name within its category, from any of its spellings: bare, below the category, or below the root."""
    key = value.lstrip("/")
    for prefix in (f"{root.rstrip('/')}/", f"{category}/"):
        key = key.removeprefix(prefix.lstrip("/"))
    return key


@dataclass(frozen=True)
class Settings:
    """What a deployment may set; ``from_env`` reads SIGLOOM_<NAME>."""

    # models
    project: str = ""
    location: str = "us-central1"
    model_simple: str = "simple"
    model_medium: str = "medium"
    model_complex: str = "complex"
    temperature: float = 0.2
    # gate and extraction
    gate_tier: str = "simple"
    threshold: float = 0.5
    gate_chars: int = 3000
    max_chars: int = 30_000
    chunk_chars: int = 12_000
    # hashes of external references
    hash_enabled: bool = True
    hash_cache_path: str = "output/external_ref_hash_cache.json"
    hash_ttl_days: int = 30
    # crawl
    user_agent: str = "sigloom/0.1"
    state_path: str = "output/crawl_state"
    workers: int = 4
    feed_max_entries: int = 50
    feed_since_days: int = 90
    # discovery
    max_candidates: int = 50
    max_terms: int = 80
    # taxonomy
    taxonomy_cache_path: str = "schema/threat_taxonomy.cached.json"
    taxonomy_source_path: str = ""
    # issue tracker
    issue_token: str = dataclasses.field(default="", repr=False)
    issue_repo: str = ""
    issue_api: str = ""
    # storage
    storage: str = "local"
    storage_root: str = "output"
    storage_bucket: str = ""
    storage_prefix: str = ""

    @classmethod
    def from_env(cls, env: dict[str, str]) -> Settings:
        """The settings of an environment. ``ACTIVITY_WINDOW_DAYS`` is the age of feeds unless that is set itself."""
        given = {}
        for f in dataclasses.fields(cls):
            raw = env.get(f"SIGLOOM_{f.name.upper()}", env.get("ACTIVITY_WINDOW_DAYS") if f.name == "feed_since_days" else None)
            if raw is not None:
                given[f.name] = raw.lower() not in ("0", "false", "no", "off") if isinstance(f.default, bool) else type(f.default)(raw)
        return cls(**given)

    def root(self) -> str:
        """Where things are stored: a folder, or a bucket's URI."""
        if self.storage == "local":
            return self.storage_root
        if not self.storage_bucket:
            raise ValueError("storage other than local needs storage_bucket")
        return "/".join(x.strip("/") for x in (f"{self.storage}://{self.storage_bucket}", self.storage_prefix) if x)


def prompt(template: str, values: dict[str, Column]) -> Column:
    """A template with each ``{{NAME}}`` replaced by a column."""
    out = F.lit(template)
    for name, column in values.items():
        out = F.replace(out, F.lit(f"{{{{{name}}}}}"), column)
    return out


def pir_short(longest: int = 240, most: int = 8) -> Column:
    """A requirement in short, for a prompt."""
    none = F.array().cast("array<string>")
    return F.struct(
        "pir_id",
        text.truncated(F.coalesce("description", F.lit("")), longest + 1, "…").alias("description"),
        F.slice(F.coalesce("threat_actor_tags", none), 1, most).alias("threat_actor_tags"),
        F.slice(F.coalesce(F.transform("prioritized_actors", lambda a: a["name"]), none), 1, most).alias("actors"),
    )


def pir_lines() -> Column:
    """A requirement as lines of Markdown; what it hasn't is left out."""
    listed = lambda name, values: F.when(F.size(values) > 0, F.concat(F.lit(f"- {name}: "), F.array_join(values, ", ")))
    line = lambda name: F.when(F.coalesce(F.col(name), F.lit("")) != "", F.concat(F.lit(f"- {name}: "), name))
    tags = text.sorted_set(F.transform("asset_weight_rules", lambda r: r["tag"]))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("### "), "pir_id"),
        line("intelligence_level"),
        line("description"),
        listed("threat_actor_tags", F.col("threat_actor_tags")),
        listed("notable_groups", F.col("notable_groups")),
        listed("collection_focus", F.col("collection_focus")),
        listed("prioritized_asset_tags", tags),
    )


def pir_block(pirs: DataFrame) -> DataFrame:
    """One row: requirements as a Markdown block for an extraction's prompt, in order; empty without any. A configuration set."""
    blocks = pirs.agg(F.array_sort(F.collect_list(F.struct("pos", pir_lines().alias("b")))).alias("bs"))
    head = "## Requirements (what matters most; not a filter on what to extract)\n\n"
    return blocks.select(F.when(F.size("bs") > 0, F.concat(F.lit(head), F.array_join(F.transform("bs", lambda b: b["b"]), "\n\n"), F.lit("\n"))).otherwise("").alias("block"))


def pir_context(pirs: DataFrame, longest: int = 240, most: int = 8) -> DataFrame:
    """One row: requirements in short as JSON, for a prompt. A configuration set, so one small group."""
    short = pir_short(longest, most)
    return pirs.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("pos", short.alias("s")))), lambda x: x["s"])).alias("context"))

