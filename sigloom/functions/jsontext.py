"""JSON out of model responses: whole, fenced, from the first bracket, or salvaged."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FENCE = r"```(?:json)?\s*\n([\s\S]+?)\n```"


def scan_array(raw: str, key: str) -> list[str]:
    """The complete objects of the array under ``key``, as texts, however the text goes on behind them."""
    at = raw.find(f'"{key}"')
    at = raw.find("[", at) if at >= 0 else -1
    out: list[str] = []
    depth, begin, quoted, escaped = 0, -1, False, False
    for i in range(at + 1, len(raw) if at >= 0 else 0):
        c = raw[i]
        if quoted:
            quoted, escaped = (c != '"' or escaped), c == "\\" and not escaped
        elif c == '"':
            quoted = True
        elif c == "{":
            begin, depth = (i if depth == 0 else begin), depth + 1
        elif c == "}" and depth:
            depth -= 1
            if depth == 0:
                out.append(raw[begin : i + 1])
        elif c == "]" and depth == 0:
            break
    return out


@F.pandas_udf(T.StringType())
def salvaged(raws: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """What can be saved of a truncated extraction: a JSON text of its complete entities and relationships."""
    for raw in raws:
        out = []
        for text in raw:
            found = {k: scan_array(text, k) for k in ("entities", "relationships")} if isinstance(text, str) else {}
            whole = ",".join(f'"{k}":[{",".join(v)}]' for k, v in found.items() if v)
            out.append(f"{{{whole}}}" if whole else None)
        yield pd.Series(out, dtype=object)


def ladder(raw) -> Column:
    """The response as JSON text: itself, its fenced block, or what begins at its first bracket; null if none parses."""
    x = F.col(raw) if isinstance(raw, str) else raw
    fenced = F.nullif(F.regexp_extract(x, _FENCE, 1), F.lit(""))
    bracket = F.nullif(F.regexp_extract(x, r"([\[{][\s\S]*)", 1), F.lit(""))
    out = None
    for step in (x, fenced, bracket):
        ok = F.when(F.try_parse_json(step).isNotNull(), step)
        out = ok if out is None else F.coalesce(out, ok)
    return out


def extraction_json(raw) -> Column:
    """The ladder with salvage as its last step (the only one that leaves the JVM, with what the ladder can't read)."""
    x = F.col(raw) if isinstance(raw, str) else raw
    return F.coalesce(ladder(x), salvaged(F.when(ladder(x).isNull(), x)))


def partial_verdict(raw) -> Column:
    """Score and ids scraped from a truncated verdict; null without a score."""
    x = F.col(raw) if isinstance(raw, str) else raw
    score = F.nullif(F.regexp_extract(x, r'"score"\s*:\s*([0-9]+(?:\.[0-9]+)?)', 1), F.lit("")).try_cast("double")
    ids = F.regexp_extract_all(F.regexp_extract(x, r'"matched_pir_ids"\s*:\s*\[([^\]]*)\]', 1), F.lit('"([^"]+)"'), 1)
    return F.when(score.isNotNull(), F.struct(score.alias("score"), ids.alias("matched_pir_ids")))
