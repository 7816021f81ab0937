"""Language identification by multilingual mixture inference.

Per language, character trigrams (over letters, lower-cased, with word boundaries, hashed into a
table) give a likelihood for every word. A document is a mixture: expectation-maximisation
estimates the proportions of the languages from its words' likelihoods. Sets of 1, 2, 3 ... up to
all languages, taken by their proportion, are then fitted again, and the set with the best
penalised likelihood (a logarithm of the words per free parameter) is selected. Larger sets are
fitted while they could still win: the mixture of all languages bounds what any set can reach. The
prediction is the selected language with the largest proportion, and that proportion is the score.

The models are fitted on a bounded sample: about ``per_language`` documents of each label (those
with the smallest hashes of their ids), whole texts, of the rows where ``train`` holds. Everything
else covers all rows. Prediction reads the text only and is one map over the table.

Null texts and those without a letter are ``und`` with score 0, as is everything when no labelled
row can be learned from; ties go to the language that sorts first; repeated rows are judged alike;
long texts are judged whole; an empty table gives no rows. Other columns aren't read, whatever
their names, and ``keep_identified`` returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, strings

BUCKETS = 1 << 16
PER_LANGUAGE = 1500
ROUNDS = 8
#: Nats that a set's likelihood may exceed that of the mixture of all languages by, as EM stops after ROUNDS.
SLACK = 2.0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x10000)), dtype=bool, count=0x10000)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets in text order, the first trigram of each word, and each word's document."""
    lowered = [t.lower() for t in texts]
    code = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[np.minimum(code, 0xFFFF)]
    high = np.flatnonzero(code > 0xFFFF)
    if len(high):
        known = {int(c): chr(c).isalpha() for c in np.unique(code[high])}
        letter[high] = [known[int(c)] for c in code[high]]
    at = np.flatnonzero(letter)
    code = np.where(letter, code, 0).astype(np.uint32)
    h = code[at - 1] * np.uint32(0x9E3779B1) ^ code[at] * np.uint32(0x85EBCA77) ^ code[at + 1] * np.uint32(0xC2B2AE3D)
    h = (h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
    words = np.flatnonzero(~letter[at - 1]) if len(at) else np.zeros(0, dtype=np.int64)
    first = 1 + np.cumsum([0, *(len(t) + 1 for t in lowered)])
    owner = np.searchsorted(first, at[words], side="right") - 1
    return (h >> np.uint32(16)).astype(np.int64), words, owner


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # BUCKETS x languages, log probabilities

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, list[str]]:
        """Language, score and selected set (``lang:share``) of each text."""
        names = ["und"] * len(texts)
        score = np.zeros(len(texts))
        sets = [""] * len(texts)
        if not self.languages:
            return names, score, sets
        buckets, words, owner = features(texts)
        if not len(words):
            return names, score, sets
        like = np.add.reduceat(self.table[buckets], words, axis=0).astype(np.float64)
        docs, start = np.unique(owner, return_index=True)
        size = np.diff(np.append(start, len(owner)))
        top = like.max(axis=1)
        share = np.exp(like - top[:, None])
        row = np.repeat(np.arange(len(docs)), size)
        full, most = _mixture(share, row, start, size, np.full((len(docs), len(self.languages)), 1 / len(self.languages)))
        most = most + np.add.reduceat(top, start) + SLACK
        order = np.argsort(-full, axis=1, kind="stable")
        single = np.add.reduceat(like, start, axis=0)
        best = np.zeros_like(full)
        best[np.arange(len(docs)), single.argmax(axis=1)] = 1
        value = single.max(axis=1)
        for k in range(2, 1 + len(self.languages)):
            some = np.flatnonzero(most - (k - 1) * np.log(size + 1.0) > value)
            if not len(some):
                break
            inside = np.isin(row, some)
            begin = np.concatenate(([0], np.cumsum(size[some])[:-1]))
            pi = np.zeros((len(some), len(self.languages)))
            np.put_along_axis(pi, order[some, :k], 1 / k, axis=1)
            pi, fit = _mixture(share[inside], np.repeat(np.arange(len(some)), size[some]), begin, size[some], pi)
            fit += np.add.reduceat(top[inside], begin) - (k - 1) * np.log(size[some] + 1.0)
            won = fit > value[some]
            value[some[won]], best[some[won]] = fit[won], pi[won]
        pick = best.argmax(axis=1)
        score[docs] = np.minimum(1.0, best[np.arange(len(docs)), pick])
        for d, p, b in zip(docs, pick, best):
            names[d] = self.languages[p]
            chosen = np.flatnonzero(b > 1e-4)
            sets[d] = ",".join(f"{self.languages[i]}:{b[i]:.3f}" for i in chosen[np.argsort(-b[chosen], kind="stable")])
        return names, score, sets


def _mixture(share, row, start, size, pi) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after ROUNDS of EM, and the log likelihood (less each word's largest)."""
    for _ in range(ROUNDS):
        r = share * pi[row]
        r /= np.maximum(r.sum(axis=1, keepdims=True), 1e-300)
        pi = np.add.reduceat(r, start, axis=0) / size[:, None]
    return pi, np.add.reduceat(np.log(np.maximum((share * pi[row]).sum(axis=1), 1e-300)), start)


def fit(
    docs: DataFrame,
    train: Column,
    per_language: int = PER_LANGUAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Trigram models from a bounded sample of the labelled rows; only counts reach the driver."""
    labelled = docs.where(train).select(
        F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")
    ).where("lang is not null and text is not null")
    totals = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = tuple(sorted(totals))
    if not names:
        return Model((), np.zeros((BUCKETS, 0), dtype=np.float32))
    where = {name: i for i, name in enumerate(names)}
    limit = F.create_map(*(x for n in names for x in (F.lit(n), F.lit(int(min(1.0, per_language / totals[n]) * (1 << 30))))))
    sample = labelled.where(F.pmod(F.xxhash64("i"), F.lit(1 << 30)) < limit[F.col("lang")]).select("text", "lang").repartition(8)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(names), BUCKETS), dtype=np.int64)
        for batch in pieces(batches, text=0):
            langs = np.array([where[x] for x in batch.column(1).to_pylist()])
            buckets, words, owner = features(batch.column(0).to_pylist())
            if len(words):
                language = langs[np.repeat(owner, np.diff(np.append(words, len(buckets))))]
                np.add.at(counts, (language, buckets), 1)
        yield pa.RecordBatch.from_arrays([pa.array([counts.astype("<i8").tobytes()], pa.binary())], names=["counts"])

    counts = np.zeros((len(names), BUCKETS))
    for part in sample.mapInArrow(count, "counts binary").toLocalIterator():
        counts += np.frombuffer(part["counts"], dtype="<i8").reshape(counts.shape)
    table = np.log((counts + 0.05) / (counts.sum(axis=1, keepdims=True) + 0.05 * BUCKETS))
    return Model(names, np.ascontiguousarray(table.T, dtype=np.float32))


def identify(docs: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=2):
            names, score, sets = model.predict(strings(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(sets, pa.string())],
                names=["doc_id", "held_out", "lang_pred", "score", "languages"],
            )

    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), held_out.alias("held_out"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, languages string")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose main language has a share of at least ``least``, with all their columns."""
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=where):
            names, score, _ = model.predict(strings(batch.column(where)))
            yield batch.filter(pa.array([n != "und" and s >= least for n, s in zip(names, score)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
