"""Field rules of configuration documents, kept as data and checked in the JVM.

A document is a JSON text (path, value). A ``Section`` is a place in it that holds objects of one
shape: a list (``assets[]``), a list within each item of a list, or a single object. Each section's
items are unfolded once, all rules of a section are tried in that one pass, and every violation is a
row (path, severity, code, location, message) whose location joins the steps by dots.

Values are read leniently: numbers may be written as strings, but a string may not be a number.
White space at the ends of strings doesn't count.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text


@dataclass(frozen=True)
class Rule:
    kind: str = "string"  # string, number, integer, boolean, date, list, object
    required: bool = False
    null: bool = False
    least: int = 0  # characters of a string
    low: float | None = None
    high: float | None = None
    above: float | None = None
    words: tuple[str, ...] = ()


@dataclass(frozen=True)
class Section:
    steps: tuple[str, ...]
    rules: dict[str, Rule]
    closed: bool = True  # no other keys
    before: tuple[tuple[str, str], ...] = ()  # the first must precede the second, where both are given


@dataclass(frozen=True)
class Document:
    code: str
    sections: tuple[Section, ...]
    required: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)


NEED, TEXT, MAYBE = Rule(required=True, least=1), Rule(), Rule(null=True)
LIST, FLAG = Rule("list"), Rule("boolean")
_SHARE = Rule("number", null=True, low=0, high=1)
_COMPONENT = {
    "score": Rule("number", required=True, low=0, high=1),
    **{
        name: _SHARE
        for name in (
            "motivation_alignment industry_match ir_observed ttp_count_norm sophistication_score recency_active_campaigns tool_usage "
            "targeting_persistence evasion_capability depth breadth victimology_match geographic_match surface_ttp_coverage"
        ).split()
    },
}
_VERSION = Section((), {"version": Rule("integer", low=1)}, closed=False)
_ACTOR = ("pirs[]", "prioritized_actors[]")

DOCUMENTS = {
    "assets": Document(
        "ASSETS_SCHEMA",
        (
            Section(("network_segments[]",), {k: NEED for k in ("id", "name", "cidr", "zone")}),
            Section(("security_controls[]",), {"id": NEED, "name": NEED, "control_type": MAYBE, "coverage": LIST}),
            Section(
                ("assets[]",),
                {
                    "id": NEED,
                    "name": NEED,
                    **{k: MAYBE for k in ("asset_type", "environment", "owner", "network_segment_id")},
                    "criticality": Rule("number", low=0, high=10),
                    "exposed_to_internet": FLAG,
                    "tags": LIST,
                    "security_control_ids": LIST,
                },
            ),
            Section(("asset_vulnerabilities[]",), {"asset_id": NEED, "vuln_stix_id_ref": NEED, "remediation_status": TEXT}),
            Section(("asset_connections[]",), {"src": NEED, "dst": NEED, "protocol": MAYBE, "port": Rule("integer", null=True, low=0, high=65535)}),
            Section(("actor_targets[]",), {"actor_stix_id_ref": NEED, "asset_id": NEED, "confidence": Rule("integer", null=True, low=0, high=100)}),
        ),
    ),
    "identity_assets": Document(
        "IDENTITY_ASSETS_SCHEMA",
        (
            _VERSION,
            Section(
                ("identities[]",),
                {
                    "id": NEED,
                    "name": NEED,
                    "identity_class": Rule(words=vocab.IDENTITY_CLASSES),
                    "sectors": LIST,
                    "roles": LIST,
                    "description": TEXT,
                    "is_high_value_impersonation_target": FLAG,
                    "impersonation_risk_factors": LIST,
                },
            ),
            Section(
                ("has_access[]",),
                {"identity_id": NEED, "asset_id": NEED, "access_level": Rule(words=vocab.ACCESS_LEVELS), "role": TEXT, "granted_at": TEXT, "revoked_at": TEXT},
                before=(("granted_at", "revoked_at"),),
            ),
        ),
    ),
    "user_accounts": Document(
        "USER_ACCOUNTS_SCHEMA",
        (
            _VERSION,
            Section(
                ("user_accounts[]",),
                {
                    "id": NEED,
                    "account_login": NEED,
                    "display_name": TEXT,
                    "account_type": Rule(words=(*vocab.ACCOUNT_TYPES, "")),
                    "is_privileged": FLAG,
                    "is_service_account": FLAG,
                    "identity_id": TEXT,
                    "description": TEXT,
                },
            ),
            Section(
                ("account_on_asset[]",),
                {"user_account_id": NEED, "asset_id": NEED, "first_seen": TEXT, "last_seen": TEXT},
                before=(("first_seen", "last_seen"),),
            ),
        ),
    ),
    "sources": Document(
        "SOURCES_SCHEMA",
        (
            Section((), {"version": Rule("integer", low=1), "sources": LIST}),
            Section(
                ("sources[]",),
                {
                    "url": NEED,
                    "label": MAYBE,
                    "task": Rule(words=("simple", "medium", "complex")),
                    "max_chars": Rule("integer", null=True, above=0),
                    "pir_ids": LIST,
                    "feed_type": Rule(null=True, words=("html", "rss", "atom")),
                },
            ),
        ),
    ),
    "pir": Document(
        "PIR_SCHEMA",
        (
            Section(
                ("pirs[]",),
                {
                    "pir_id": NEED,
                    "threat_actor_tags": LIST,
                    "asset_weight_rules": LIST,
                    "valid_from": Rule("date", required=True),
                    "valid_until": Rule("date", required=True),
                    **{k: MAYBE for k in ("organizational_scope", "description", "intelligence_level")},
                    "prioritized_actors": Rule("list", required=True),
                },
                closed=False,
                before=(("valid_from", "valid_until"),),
            ),
            Section(("pirs[]", "asset_weight_rules[]"), {"tag": NEED, "criticality_multiplier": Rule("number", required=True, above=0)}),
            Section(
                _ACTOR,
                {
                    "actor_id": NEED,
                    "name": NEED,
                    "aliases": LIST,
                    "likelihood": Rule("number", required=True, low=0, high=1),
                    "score_breakdown": Rule("object", required=True),
                    "rationale": Rule("object", required=True),
                },
                closed=False,
            ),
            Section((*_ACTOR, "score_breakdown"), {k: Rule("object", required=True) for k in ("intent", "capability", "opportunity")}, closed=False),
            *(Section((*_ACTOR, "score_breakdown", k), _COMPONENT) for k in ("intent", "capability", "opportunity")),
            Section((*_ACTOR, "rationale"), {"text": Rule(required=True)}, closed=False),
        ),
    ),
}

_KINDS = {"string": "a string", "number": "a number", "integer": "an integer", "boolean": "true or false", "date": "a date", "list": "a list", "object": "an object"}
FOUND = "path string, severity string, code string, location string, message string"


def _value(name: str) -> Column:
    return F.try_variant_get("item", f"$.{name}", "variant")


def _string(name: str) -> Column:
    return text.strip(F.try_variant_get("item", f"$.{name}", "string"))


def _typed(name: str, rule: Rule) -> Column:
    """Whether the value is of the rule's kind."""
    is_a = F.schema_of_variant(_value(name))
    numeric = is_a.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)")
    number = F.try_variant_get("item", f"$.{name}", "string").try_cast("double")
    return {
        "string": is_a == "STRING",
        "number": (numeric | (is_a == "STRING")) & number.isNotNull(),
        "integer": (numeric | (is_a == "STRING")) & number.isNotNull() & (number == F.floor(number)),
        "boolean": is_a == "BOOLEAN",
        "date": (is_a == "STRING") & F.try_to_timestamp(_string(name), F.lit("yyyy-MM-dd")).isNotNull(),
        "list": is_a.startswith("ARRAY"),
        "object": is_a.startswith("OBJECT"),
    }[rule.kind]


def _problem(name: str, rule: Rule) -> Column:
    """What is wrong with a field, or null."""
    value = _value(name)
    absent = value.isNull()
    void = F.coalesce(F.is_variant_null(value), F.lit(False))
    number = F.try_variant_get("item", f"$.{name}", "string").try_cast("double")
    out = F.when(absent, "is missing" if rule.required else F.lit(None).cast("string"))
    out = out.when(void, F.lit(None).cast("string") if rule.null else f"is not {_KINDS[rule.kind]}")
    out = out.when(~F.coalesce(_typed(name, rule), F.lit(False)), f"is not {_KINDS[rule.kind]}")
    if rule.least:
        out = out.when(F.length(_string(name)) < rule.least, "is empty")
    if rule.words:
        out = out.when(~_string(name).isin(*rule.words), "is not in its vocabulary")
    if rule.low is not None:
        out = out.when(number < rule.low, f"is below {rule.low}")
    if rule.high is not None:
        out = out.when(number > rule.high, f"is above {rule.high}")
    if rule.above is not None:
        out = out.when(number <= rule.above, f"is not above {rule.above}")
    return out


def _items(parsed: DataFrame, steps: tuple[str, ...]) -> DataFrame:
    """(path, at, item): the objects of a section and where they are."""
    out = parsed.select("path", F.lit("").alias("at"), F.col("v").alias("item"))
    for step in steps:
        name = step.removesuffix("[]")
        here = F.concat(F.col("at"), F.when(F.col("at") == "", "").otherwise("."), F.lit(name))
        if step.endswith("[]"):
            out = out.select("path", here.alias("at"), F.posexplode(F.try_variant_get("item", f"$.{name}", "array<variant>")).alias("pos", "item"))
            out = out.select("path", F.concat("at", F.lit("."), F.col("pos").cast("string")).alias("at"), "item")
        else:
            out = out.select("path", here.alias("at"), _value(name).alias("item")).where(F.schema_of_variant("item").startswith("OBJECT"))
    return out


def _section(parsed: DataFrame, section: Section, code: str) -> DataFrame:
    items = _items(parsed, section.steps).withColumn("object", F.schema_of_variant("item").startswith("OBJECT"))
    hit = lambda name, why: F.struct(F.lit(name).cast("string").alias("name"), F.concat(F.lit(f"{name} ") if name else F.lit(""), why).alias("message"))
    problems = {name: _problem(name, rule) for name, rule in section.rules.items()}
    found = [F.when(F.col("object") & p.isNotNull(), hit(name, p)) for name, p in problems.items()]
    found.append(F.when(~F.col("object"), hit(None, F.lit("is not an object"))))
    for a, b in section.before:
        both = problems[a].isNull() & problems[b].isNull() & (_string(a) != "") & (_string(b) != "")
        found.append(F.when(F.col("object") & both & (_string(a) >= _string(b)), hit(None, F.lit(f"{a} must precede {b}"))))
    hits = F.filter(F.array(*found), lambda h: h.isNotNull())
    if section.closed:
        keys = F.map_keys(F.from_json(F.when(F.col("object"), F.to_json("item")), "map<string,string>"))
        more = F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*(F.lit(k) for k in section.rules)))
        hits = F.concat(hits, F.transform(more, lambda k: F.struct(k.alias("name"), F.concat(k, F.lit(" is not known")).alias("message"))))
    rows = items.select("path", "at", F.inline(hits))
    where = F.concat_ws(".", F.nullif("at", F.lit("")), "name")
    return rows.select("path", F.lit("error").alias("severity"), F.lit(code).alias("code"), where.alias("location"), "message")


def check(raw: DataFrame, kind: str, path: str = "path", value: str = "value") -> DataFrame:
    """Findings (path, severity, code, location, message) of documents of one kind."""
    document = DOCUMENTS[kind]
    parsed = raw.select(F.col(path).cast("string").alias("path"), F.try_parse_json(value).alias("v"))
    shaped = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    lists = sorted({s.steps[0].removesuffix("[]") for s in document.sections if s.steps})
    broken = parsed.where(~shaped).select("path", F.lit("").alias("location"), F.lit("is not an object").alias("message"))
    odd = [
        F.when(_value(name).isNotNull() & ~F.coalesce(F.schema_of_variant(_value(name)).startswith("ARRAY"), F.lit(False)), F.lit(name)) for name in lists
    ]
    listed = parsed.where(shaped).withColumnRenamed("v", "item").select("path", F.explode(F.filter(F.array(*odd), lambda o: o.isNotNull())).alias("location"))
    shape = broken.unionByName(listed.withColumn("message", F.concat("location", F.lit(" is not a list"))))
    shape = shape.select("path", F.lit("error").alias("severity"), F.lit(document.code).alias("code"), "location", "message")
    return reduce(DataFrame.unionByName, [_section(parsed.where(shaped), s, document.code) for s in document.sections], shape)


def check_pir_envelope(raw: DataFrame, path: str = "path", value: str = "value") -> DataFrame:
    """Documents of requirements that come without their envelope (bare lists too), or with a version that isn't read."""
    parsed = raw.select(F.col(path).cast("string").alias("path"), F.try_parse_json(value).alias("item"))
    wrapped = F.coalesce(F.schema_of_variant("item").startswith("OBJECT") & _value("pirs").isNotNull(), F.lit(False))
    version = F.try_variant_get("item", "$.schema_version", "string")
    why = (
        F.when(~wrapped, "the list must be wrapped as pirs beside a schema_version")
        .when(version.isNull(), "schema_version is missing")
        .when(version.isin(*vocab.OLD_SCHEMA_VERSIONS), F.concat(F.lit("schema_version "), version, F.lit(f" is no longer read; produce {vocab.SCHEMA_VERSION}")))
        .when(version != vocab.SCHEMA_VERSION, F.concat(F.lit("schema_version "), version, F.lit(" is not known")))
    )
    code = F.when(~wrapped, "PIR_SCHEMA_ENVELOPE").otherwise("PIR_SCHEMA")
    location = F.when(wrapped, "schema_version").otherwise(F.col("path"))
    return parsed.where(why.isNotNull()).select("path", F.lit("error").alias("severity"), code.alias("code"), location.alias("location"), why.alias("message"))


# --- typed tables -----------------------------------------------------------------------------

_TABLES = {
    "network_segments": "id string, name string, cidr string, zone string",
    "security_controls": "id string, name string, control_type string, coverage array<string>",
    "assets": "id string, name string, asset_type string, environment string, criticality double, owner string, network_segment_id string, "
    "exposed_to_internet boolean, tags array<string>, security_control_ids array<string>",
    "asset_vulnerabilities": "asset_id string, vuln_stix_id_ref string, remediation_status string",
    "asset_connections": "src string, dst string, protocol string, port int",
    "actor_targets": "actor_stix_id_ref string, asset_id string, confidence int",
    "identities": "id string, name string, identity_class string, sectors array<string>, roles array<string>, description string, "
    "is_high_value_impersonation_target boolean, impersonation_risk_factors array<string>",
    "has_access": "identity_id string, asset_id string, access_level string, role string, granted_at string, revoked_at string",
    "user_accounts": "id string, account_login string, display_name string, account_type string, is_privileged boolean, is_service_account boolean, "
    "identity_id string, description string",
    "account_on_asset": "user_account_id string, asset_id string, first_seen string, last_seen string",
}
_DEFAULTS = {
    "assets": {"criticality": 5.0, "exposed_to_internet": False},
    "asset_vulnerabilities": {"remediation_status": "open"},
    "identities": {"identity_class": "group", "description": "", "is_high_value_impersonation_target": False},
    "has_access": {"access_level": "read", "role": "", "granted_at": "", "revoked_at": ""},
    "user_accounts": {"display_name": "", "account_type": "", "is_privileged": False, "is_service_account": False, "identity_id": "", "description": ""},
    "account_on_asset": {"first_seen": "", "last_seen": ""},
}


def tables(raw: DataFrame, kind: str, value: str = "value") -> dict[str, DataFrame]:
    """The lists of documents as tables with ``pos`` and their defaults filled in, as ``integrity`` takes them."""
    out = {}
    for section in DOCUMENTS[kind].sections:
        if len(section.steps) != 1:
            continue
        name = section.steps[0].removesuffix("[]")
        if name not in _TABLES:
            continue
        schema = _TABLES[name]
        doc = F.from_json(value, f"{name} array<struct<{', '.join(c.replace(' ', ':', 1) for c in schema.split(', '))}>>")
        rows = raw.select(F.posexplode(doc[name]).alias("pos", "x")).select("pos", "x.*")
        for column, default in _DEFAULTS.get(name, {}).items():
            rows = rows.withColumn(column, F.coalesce(column, F.lit(default)))
        for column in (c.split()[0] for c in schema.split(", ") if "array" in c):
            rows = rows.withColumn(column, F.coalesce(column, F.array().cast("array<string>")))
        out[name] = rows
    return out
