"""Quality rules by repetition coverage.

Words get exact ids within their document. Over these, numpy computes rolling hashes of n-grams of
several lengths; the characters of words inside n-grams that occur twice or more, and those of
lines equal to an earlier one, are measured against all characters in words. A document is kept if
no share exceeds its threshold, its symbols per word and its words' mean length are in range, and
the base rules hold. Thresholds are parameters and hold alike for every document.

Three-word windows (a base column) are compared by their ids, not by hashes, so that counts are exact.
Nulls and empty texts have no words and fail the base rule; rows are independent of each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WORD, pieces, strings

_WORD = re.compile(WORD)
_SYMBOL = re.compile(r"[#*$%&|<>]")
#: What str.split takes for white space although it is none here.
_ODD = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: n-gram length -> largest share of characters in words inside repeated n-grams
    coverage: dict[int, float] = field(default_factory=lambda: {5: 0.50, 6: 0.48, 8: 0.45, 10: 0.42})
    max_line_coverage: float = 0.40
    max_symbols_per_word: float = 0.25
    mean_word: tuple[float, float] = (2.0, 20.0)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text) if _ODD.search(text) else text.split()


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries occur twice or more."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    hit = np.zeros(len(keys), dtype=bool)
    hit[order[1:]] = same
    hit[order[:-1]] |= same
    return hit


def _inside(hit: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words are in a window of ``n`` that begins at a hit."""
    edge = np.zeros(words + 1, dtype=np.int32)
    starts = np.flatnonzero(hit)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


@dataclass
class Measures:
    n_words: int = 0
    word_chars: int = 0
    n_symbols: int = 0
    n_dup_lines: int = 0
    n_repeat_words: int = 0
    line_coverage: float = 0.0
    coverage: dict[int, float] = field(default_factory=dict)


def measure(text: str, lengths: tuple[int, ...] = (5, 6, 8, 10)) -> Measures:
    words = words_of(text)
    n = len(words)
    m = Measures(n_words=n, n_symbols=len(_SYMBOL.findall(text)))
    if not n:
        return m
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=n)
    size = np.fromiter(map(len, words), dtype=np.int64, count=n)
    m.word_chars = int(size.sum())
    if "\n" in text:
        seen: set[str] = set()
        again = 0
        for line in text.split("\n"):
            own = words_of(line)
            if own:
                if line in seen:
                    m.n_dup_lines += 1
                    again += sum(map(len, own))
                else:
                    seen.add(line)
        m.line_coverage = again / m.word_chars
    m.coverage = dict.fromkeys(lengths, 0.0)
    if len(index) == n:
        return m  # every word is another: nothing is repeated
    if n >= 3:
        if len(index) < 1 << 21:
            hit = _repeated(ids[:-2] << 42 | ids[1:-1] << 21 | ids[2:])
        else:
            pairs = np.unique(np.stack((ids[:-1], ids[1:])), axis=1, return_inverse=True)[1].ravel().astype(np.int64)
            hit = _repeated(pairs[:-1] * (int(ids.max()) + 1) + ids[2:])
        if not hit.any():
            return m  # nor is any longer n-gram
        m.n_repeat_words = int(_inside(hit, 3, n).sum())
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * _BASE
        mixed ^= mixed >> np.uint64(29)
        rolling, done = mixed.copy(), 1
        for k in sorted(lengths):
            if n < k:
                break
            for i in range(done, k):
                rolling = rolling[: n - i] * _BASE + mixed[i:]
            done = k
            hit = _repeated(rolling)
            if not hit.any():
                break
            m.coverage[k] = float(size[_inside(hit, k, n)].sum()) / m.word_chars
    return m


def base_failed(m: Measures, rules: Rules) -> bool:
    return m.n_words < rules.min_words or 100 * m.n_repeat_words > rules.max_repeat_percent * m.n_words


def keeps(m: Measures, rules: Rules) -> bool:
    if base_failed(m, rules) or m.line_coverage > rules.max_line_coverage:
        return False
    if m.n_symbols > rules.max_symbols_per_word * m.n_words:
        return False
    if not rules.mean_word[0] <= m.word_chars / m.n_words <= rules.mean_word[1]:
        return False
    return all(m.coverage.get(k, 0.0) <= most for k, most in rules.coverage.items())


def quality(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures and verdict for every row; one map over the table, no shuffle."""
    lengths = tuple(sorted(rules.coverage))
    last = lengths[-1] if lengths else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1024, text=1):
            ms = [measure(t, lengths) for t in strings(batch.column(1))]
            longs = [[getattr(m, name) for m in ms] for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(x, pa.int64()) for x in longs),
                    pa.array([base_failed(m, rules) for m in ms], pa.bool_()),
                    pa.array([keeps(m, rules) for m in ms], pa.bool_()),
                    pa.array([m.line_coverage for m in ms], pa.float64()),
                    pa.array([m.coverage.get(last, 0.0) for m in ms], pa.float64()),
                ],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "line_coverage", "ngram_coverage"],
            )

    return docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(
        run,
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean, line_coverage double, ngram_coverage double",
    )


def keep_quality(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    where = docs.columns.index(text_col)
    lengths = tuple(sorted(rules.coverage))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1024, text=where):
            yield batch.filter(pa.array([keeps(measure(t, lengths), rules) for t in strings(batch.column(where))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
