"""The grammar of indicator patterns: a tokeniser and a recursive-descent check.

observations: ``[comparisons]`` joined by AND, OR and FOLLOWEDBY, in parentheses, with the
qualifiers WITHIN, REPEATS and START ... STOP. Comparisons: ``type:path op literal`` joined by AND
and OR, in parentheses, negated by NOT, or EXISTS.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(
    r"""\s*(?:
        (?P<literal>(?:[htb])?'(?:[^'\\]|\\.)*')
      | (?P<path>[A-Za-z0-9_-]+:[A-Za-z_](?:[\w-]|\.(?=['\w])|'(?:[^'\\]|\\.)*'|\[(?:\*|-?\d+)\])*)
      | (?P<number>[+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)
      | (?P<word>[A-Za-z_]+)
      | (?P<op><=|>=|!=|==|=|<>|<|>)
      | (?P<mark>[\[\](),])
    )""",
    re.X | re.S,
)
_NAMED = ("IN", "LIKE", "MATCHES", "ISSUBSET", "ISSUPERSET")


def tokens(text: str) -> list[tuple[str, str]] | None:
    out, at = [], 0
    text = text.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None or m.end() == at:
            return None
        out.append((m.lastgroup, m.group(m.lastgroup)))
        at = m.end()
        while at < len(text) and text[at].isspace():
            at += 1
    return out


class _Reader:
    def __init__(self, found: list[tuple[str, str]]):
        self.found, self.at = found, 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.found) and self.found[self.at][1] in values and self.found[self.at][0] != "literal"

    def take(self, *values: str) -> bool:
        hit = self.peek(*values)
        self.at += hit
        return hit

    def kind(self, *kinds: str) -> bool:
        hit = self.at < len(self.found) and self.found[self.at][0] in kinds
        self.at += hit
        return hit

    # Operators of a level are joined in a loop; only parentheses recurse, and their depth is bounded.
    def observations(self, depth: int = 0) -> bool:
        while True:
            if not self.observation(depth):
                return False
            if not self.take("AND", "OR", "FOLLOWEDBY"):
                return True

    def observation(self, depth: int) -> bool:
        if depth > 200:
            return False
        if self.take("("):
            if not (self.observations(depth + 1) and self.take(")")):
                return False
        elif not (self.take("[") and self.comparisons(0) and self.take("]")):
            return False
        while self.peek("WITHIN", "REPEATS", "START"):
            word = self.found[self.at][1]
            self.at += 1
            if word == "START":
                if not (self.time() and self.take("STOP") and self.time()):
                    return False
            elif not (self.kind("number") and self.take("SECONDS" if word == "WITHIN" else "TIMES")):
                return False
        return True

    def time(self) -> bool:
        return self.at < len(self.found) and self.found[self.at][1].startswith("t'") and self.kind("literal")

    def comparisons(self, depth: int) -> bool:
        while True:
            if not self.comparison(depth):
                return False
            if not self.take("AND", "OR"):
                return True

    def comparison(self, depth: int) -> bool:
        if depth > 200:
            return False
        if self.take("("):
            return self.comparisons(depth + 1) and self.take(")")
        if self.take("EXISTS"):
            return self.kind("path")
        if not self.kind("path"):
            return False
        self.take("NOT")
        if self.take("IN"):
            if not self.take("("):
                return False
            while self.literal():
                if self.take(")"):
                    return True
                if not self.take(","):
                    return False
            return False
        return (self.kind("op") or self.take(*_NAMED)) and self.literal()

    def literal(self) -> bool:
        return self.kind("literal", "number") or self.take("true", "false", "True", "False", "TRUE", "FALSE")


def parses(pattern: str | None) -> bool:
    """Whether the whole text is a pattern."""
    found = tokens(pattern) if pattern else None
    if not found:
        return False
    reader = _Reader(found)
    return reader.observations() and reader.at == len(found)


@F.pandas_udf(T.BooleanType())
def valid(patterns: pd.Series) -> pd.Series:
    return patterns.map(parses).astype(bool)
