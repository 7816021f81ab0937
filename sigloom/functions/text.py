"""String functions. Each takes a column (or its name) and gives a column.

White space is Unicode's throughout, as the sources' texts hold no-break spaces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab

_WS = r"(?U)\s+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def normal(x) -> Column:
    """Stripped, lower case: how indicator values are compared."""
    return F.lower(strip(x))


def normal_name(x) -> Column:
    """Lower case with single spaces: how group names are compared."""
    return F.lower(F.regexp_replace(strip(x), _WS, " "))


def match_text(x) -> Column:
    """Lower case, underscores and white space as one space: how terms are searched."""
    return F.regexp_replace(F.lower(_c(x)), r"(?U)[_\s]+", " ")


def term(x, longest: int = 80) -> Column:
    """A search term, or null if it is too short, too long or a stopword."""
    t = F.regexp_replace(match_text(strip(x)), r"^[ _.,;:()\[\]{}-]+|[ _.,;:()\[\]{}-]+$", "")
    return F.when(F.length(t).between(3, longest) & ~t.isin(*vocab.STOPWORDS), t)


def url_key(x) -> Column:
    """The URL that duplicates share: stripped, no slashes at its end, lower case."""
    return F.lower(F.regexp_replace(strip(x), "/+$", ""))


def plain_text(x) -> Column:
    """:func:`match_text` with hyphens read as spaces.

    A text that holds a term holds it in this form too, so one search for it covers both spellings.
    """
    return F.replace(match_text(x), F.lit("-"), F.lit(" "))


def contains_term(text, needle) -> Column:
    """Whether a text holds a term, hyphens and spaces alike."""
    return F.coalesce(F.contains(plain_text(text), plain_text(needle)), F.lit(False))


def clean(x) -> Column:
    """Markup taken out, white space collapsed; null if nothing is left."""
    return F.nullif(strip(F.regexp_replace(F.regexp_replace(_c(x), "<[^>]+>", " "), _WS, " ")), F.lit(""))


def slug(url, longest: int = 80) -> Column:
    """A file name from a URL."""
    body = F.regexp_replace(F.regexp_replace(_c(url), "^https?://", ""), "[^A-Za-z0-9._-]+", "-")
    return F.coalesce(F.nullif(F.substring(F.regexp_replace(body, "^-+|-+$", ""), 1, longest), F.lit("")), F.lit("bundle"))


def keywords(x, most: int = 6) -> Column:
    """The first distinct words of four letters or more that aren't stopwords."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(_c(x)), F.lit("([a-z][a-z0-9-]{3,})"), 1))
    return F.slice(F.array_except(found, F.array(*map(F.lit, vocab.STOPWORDS))), 1, most)


def truncated(x, limit: int, suffix: str) -> Column:
    """The text, or its beginning and ``suffix``, within ``limit`` characters."""
    x = _c(x)
    return F.when(F.length(x) > limit, F.concat(F.substring(x, 1, limit - len(suffix)), F.lit(suffix))).otherwise(x)


def clipped(x, limit: int = 3000, note: str = "\n\n[...truncated]") -> Column:
    """A prompt's text: ``limit`` characters and a note if there were more."""
    x = _c(x)
    return F.when(F.length(x) > limit, F.concat(F.substring(x, 1, limit), F.lit(note))).otherwise(x)


def snippet(x, limit: int = 50) -> Column:
    return F.substring(F.regexp_replace(strip(x), _WS, " "), 1, limit)


def cell(x) -> Column:
    """A table cell of Markdown."""
    return F.replace(F.replace(_c(x), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def mime(x) -> Column:
    return F.lower(strip(F.split_part(_c(x), F.lit(";"), F.lit(1))))


def article_start(x, after: int = 500) -> Column:
    """Zero-based place of the first heading (one or two #) behind ``after`` characters; 0 if there is none."""
    at = F.regexp_instr(F.substring(_c(x), F.lit(after + 1), F.length(_c(x))), F.lit(r"\n#{1,2} .+"))
    return F.when(at > 0, at + after).otherwise(0)


#: Between paragraphs; with the separators that count as white space in Python, but not in Java.
_BLANK = r"(?U)\n[\s\x1c-\x1f]*\n"
#: Characters of two UTF-16 units, on which a counted repeat of a pattern recurses in Java.
_WIDE = r"[\x{10000}-\x{10FFFF}]"


def chunks(x, limit: int) -> Column:
    """A text that fits is one chunk; else paragraphs packed greedily, joined by an empty line.

    A paragraph beyond the limit ends the chunk before it and is cut into chunks of its own. Work is
    linear in the text and stays in the JVM: chunks are matches of one pattern, each going on where the
    last one ended. Those behind an empty line reach to the last end of a paragraph within the limit; a
    paragraph without one is cut at the limit until it ends. Long texts with characters of two UTF-16
    units are matched with one unit for each, and cut by the lengths of these matches. Unfold chunks
    with an outer explode: for a plain one Spark infers a filter that computes them twice.
    """
    x = _c(x)
    end = r"(?=\n\n|\z)"
    pattern = rf"(?s)\G(?:\n\n(?:.{{0,{limit}}}{end}|.{{{limit}}})|(?!\n\n)(?:.{{1,{limit}}}?{end}|.{{{limit}}}))"
    found = lambda t: F.regexp_extract_all(t, F.lit(pattern), 0)
    long = F.concat(F.lit("\n\n"), F.regexp_replace(F.when(F.length(x) > limit, x), _BLANK, "\n\n"))
    cut = F.aggregate(
        found(F.regexp_replace(F.when(x.rlike(_WIDE), long), _WIDE, "x")),
        F.struct(long.alias("rest"), F.array().cast("array<string>").alias("out")),
        lambda a, m: F.struct(
            F.substring(a["rest"], F.length(m) + 1, F.length(a["rest"])).alias("rest"), F.concat(a["out"], F.array(F.substring(a["rest"], F.lit(1), F.length(m)))).alias("out")
        ),
        lambda a: a["out"],
    )
    parts = F.coalesce(cut, found(long))
    return F.when(F.length(x) <= limit, F.array(x)).otherwise(F.transform(parts, lambda m: F.when(m.startswith("\n\n"), F.substring(m, 3, limit)).otherwise(m)))


def indicator_name(pattern) -> Column:
    """A short name from a pattern: ``type: value``, or what of it can be told."""
    p = _c(pattern)
    both = r"\[\s*([\w-]+)\s*:[\w.\-]+\s*=\s*'([^']{1,80})'"
    kind, value = F.regexp_extract(p, both, 1), F.regexp_extract(p, both, 2)
    alone = F.regexp_extract(p, r"\[\s*([\w-]+)\s*:", 1)
    name = F.when(kind != "", F.concat_ws(": ", kind, value)).when(alone != "", F.concat(F.lit("Indicator: "), alone))
    return F.coalesce(name, F.lit("Indicator"))


CVE = r"CVE-\d{4}-\d{4,}"


def cve_id(name, references) -> Column:
    """The CVE of a vulnerability: from a reference whose source is ``cve`` (its id, else its url), else the name."""
    from_reference = F.transform(
        F.filter(references, lambda r: F.lower(r["source_name"]) == "cve"),
        lambda r: F.coalesce(
            F.when(strip(r["external_id"]).rlike(f"^{CVE}$"), strip(r["external_id"])), F.nullif(F.regexp_extract(r["url"], CVE, 0), F.lit(""))
        ),
    )
    named = F.when(strip(name).rlike(f"^{CVE}$"), strip(name))
    return F.coalesce(F.get(F.filter(from_reference, lambda x: x.isNotNull()), F.lit(0)), named)


def hedge_confidence(x) -> Column:
    """0 to 100 from the first phrase of estimative probability found; null without one."""
    low, out = F.lower(_c(x)), None
    for value, phrases in vocab.HEDGES:
        hit = low.rlike("|".join(phrases))
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


# --- arrays -----------------------------------------------------------------------------------


def inside(values, vocabulary) -> Column:
    """Those of a list that a vocabulary has, null if none."""
    kept = F.filter(values, lambda v: v.isin(*vocabulary))
    return F.when(F.size(kept) > 0, kept)


def outside(values, vocabulary) -> Column:
    return F.coalesce(F.filter(values, lambda v: ~v.isin(*vocabulary)), F.array().cast("array<string>"))


def with_labels(labels, more) -> Column:
    """Labels with more behind them, each once, in order of appearance; null rather than empty."""
    both = F.array_union(F.coalesce(labels, F.array().cast("array<string>")), F.coalesce(more, F.array().cast("array<string>")))
    return F.when(F.size(both) > 0, both)


def as_label(value) -> Column:
    """A scalar as a list of labels: stripped, empty if there is nothing."""
    return F.when(strip(value) != "", F.array(strip(value))).otherwise(F.array().cast("array<string>"))


def sorted_set(values) -> Column:
    return F.array_sort(F.array_distinct(values))
