"""Language-model scores: a smoothed unigram base over words, and a causal self-attention model
over subwords (see ``attention``).

Documents are dealt to chunks of bounded size by a hash of id and text. 1. One map per chunk counts
the words of its training documents, notes those of the others, spells all, keeps each document as the numbers of its
words, and trains the model on every window of all its training documents (their number grows with the text) from a
common start. 2. Counts of a
word are summed over the chunks that hold it, where they are needed: one row (with its subwords) per word and chunk,
never one per occurrence, and no dictionary is broadcast. 3. The chunks' weights are averaged per
parameter, and their subword counts of training texts are added up. 4. Each chunk meets
its words (by number, so no text is read again) and scores its documents: the base from the counts, the model in batches.

What is gathered grows with the corpus: word counts cover all training texts, and each chunk adds
its windows. Chunks hold ``chunk_chars`` characters on average; a longer document is in one chunk
with others. What reaches the driver is bounded by the subword vocabulary and the weights.

The model's text is the base's: words in lower case, each with a space before it, then one end.
Its score is the sum of log10 probabilities of these subwords. Null counts as the empty text, which
is one end. Repeated rows are scored (and counted) each; without training documents every count is
0 and the weights are the initial ones; an empty table gives no rows; long texts are scored whole.
Scores don't depend on the order of rows: chunks follow from ids and texts, each is trained in the
order of hashes of its texts and scored in that of ids and hashes, and weights are averaged as integers. Other columns aren't read,
whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import attention
from .common import sizes, spans, written

CHUNK_CHARS = 24_000_000
#: Training steps of a chunk at least; one with more windows takes as many steps as meet each of them.
STEPS = 120


class Subwords:
    """Ids of words by the byte-level ranks, many words in one call."""

    def __init__(self, path: str):
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.end = len(ranks)
        self.encoding = tiktoken.Encoding("scores", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        tokens = [b""] * (self.end + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self.width = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self.class_of = attention.classes_of(tokens, self.end)
        self.kind = np.dtype("<u2" if self.end < 1 << 16 else "<u4")

    def __call__(self, words: list[bytes] | pa.Array, group: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each word."""
        words = words if isinstance(words, pa.Array) else pa.array(words, pa.large_binary())
        length = 1 + pc.binary_length(words).to_numpy()
        nothing, space = (pa.scalar(x, words.type) for x in (b"", b" "))
        spaced = memoryview(pc.binary_join_element_wise(nothing, words, space).buffers()[2] or b"")  # a space before each word
        begin = np.concatenate(([0], np.cumsum(length)))
        flat, sizes = [], []
        open_ = [(a, min(a + group, len(words))) for a in range(0, len(words), group)][::-1]
        while open_:
            a, b = open_.pop()
            text = spaced[begin[a] : begin[b]].tobytes().decode("utf-8", "replace")
            ids = self.encoding.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
            ends = np.cumsum(self.width[ids])
            cuts = begin[a + 1 : b + 1] - begin[a]
            edge = np.searchsorted(ends, cuts) + 1
            if len(ends) and ends[-1] == cuts[-1] and (ends[edge - 1] == cuts).all():
                flat.append(ids)
                sizes.append(np.diff(np.concatenate(([0], edge))))
            elif b - a > 1:  # a token reaches over two words: white space beyond ASCII
                half = (a + b) // 2
                open_ += [(half, b), (a, half)]
            else:
                flat.append(ids)
                sizes.append(np.array([len(ids)]))
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate(flat or [none]), np.concatenate(sizes or [none])


@lru_cache(maxsize=1)
def subwords_of(path: str) -> Subwords:
    return Subwords(path)


def words_of(text: str) -> list[bytes]:
    """Words in lower case; bytes.lower and bytes.split know ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split()


_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz" + b" " * 5)


def _split(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """What ``words_of`` gives, of all texts one after the other, and the number of each text's words."""
    column = column.cast(pa.large_binary())
    _, begins, data = column.buffers()
    edge = np.frombuffer(begins, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    data = memoryview(data)[edge[0] : edge[-1]].tobytes().translate(_FOLD) if data is not None else b""
    folded = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(edge - edge[0]), pa.py_buffer(data)])
    parts = pc.split_pattern(folded, " ")
    words, per = parts.flatten(), pc.list_value_length(parts).to_numpy().astype(np.int64)
    del parts, folded, data
    some = sizes(words) > 0  # the parts between two spaces aren't words
    if some.all():
        return words, per
    return words.filter(pa.array(some)), np.diff(np.concatenate(([0], np.cumsum(some)))[np.concatenate(([0], np.cumsum(per)))])


def _gather(flat: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words ``at``, one after the other, and how many each has."""
    own = size[at]
    begin = (np.cumsum(size) - size)[at]
    return flat[np.repeat(begin - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))], own


def _spelled(at: np.ndarray, per: np.ndarray, flat: np.ndarray, width: np.ndarray, end: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Subwords of texts of the words ``at``, ``per`` of them each, and an end after each text: texts, ids, number of ids."""
    first = np.concatenate(([0], np.cumsum(per)))
    for a, b in spans(per, 256, 1 << 18):
        some, own = _gather(flat, width, at[first[a] : first[b]])
        edge = np.concatenate(([0], np.cumsum(own)))[first[a : b + 1] - first[a]]
        yield slice(a, b), np.insert(some, edge[1:], end), np.diff(edge) + 1


def _all_spelled(at: np.ndarray, per: np.ndarray, flat: np.ndarray, width: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All subwords of all texts, an end after each text, and each text's number of them."""
    parts = [*_spelled(at, per, flat.astype(np.int32), width, end)]
    none = np.zeros(0, dtype=np.int32)
    return np.concatenate([x for _, x, _ in parts] or [none]), np.concatenate([n for _, _, n in parts] or [none.astype(np.int64)])


def _training_ids(texts: list[bytes], words: list[bytes], sub: Subwords) -> tuple[np.ndarray, np.ndarray]:
    """The same of texts that consist of ``words``."""
    found, per = _split(pa.array(texts, pa.large_binary()))
    return _all_spelled(_places(found, pa.array(words, pa.large_binary())), per, *sub(words), sub.end)


def _packed(flat: np.ndarray, width: np.ndarray, kind: np.dtype) -> pa.Array:
    """Ids of each word as bytes."""
    edge = np.concatenate(([0], np.cumsum(width * kind.itemsize)))
    return pa.Array.from_buffers(pa.large_binary(), len(width), [None, pa.py_buffer(edge), pa.py_buffer(flat.astype(kind))])


def _unpacked(ids: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and the number of ids of each word."""
    data = ids.cast(pa.large_binary()).buffers() if len(ids) else [None, b"\0" * 8, None]
    edge = np.frombuffer(data[1], dtype=np.int64)[ids.offset : ids.offset + len(ids) + 1]
    flat = np.frombuffer(memoryview(data[2] or b"")[edge[0] : edge[-1]], dtype=kind)
    return flat.astype(np.int32), np.diff(edge) // kind.itemsize


def _places(found: pa.Array, words: pa.Array) -> np.ndarray:
    """Where in ``words`` each of ``found`` is."""
    return pc.index_in(found, words.cast(found.type)).to_numpy()


#: Halves of the numbers of words within a chunk; the high ones are zero but for rare words, and take no space once compressed.
HALF = np.dtype("<u2")
#: Weights are averaged as integers, so that their order doesn't matter.
UNIT = 2.0**30


def _sum(rows: DataFrame, chunks: int, size: int) -> np.ndarray:
    """The sum of the chunks' packed integers, within tasks, then within fewer tasks, then here."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for x in batch.column(0):
                out += np.frombuffer(x.as_buffer(), dtype=np.int64)
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["ids"])

    parts = rows.mapInArrow(total, "ids binary")
    parts = parts.repartition(max(1, math.isqrt(chunks))).mapInArrow(total, "ids binary")
    out = np.zeros(size, dtype=np.int64)
    for row in parts.toLocalIterator():  # one small array a task
        out += np.frombuffer(row["ids"], dtype=np.int64)
    return out


def score(
    docs: DataFrame,
    held_out: Column,
    ranks: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    path = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), held_out.alias("held_out"), text.alias("text"))
    size, n_train = rows.agg(F.sum(F.length("text")), F.count_if(~F.col("held_out"))).first()
    chunks = max(1, math.ceil((size or 0) / chunk_chars))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))

    def forget() -> None:
        """Spark deletes shuffles of what is written by now when the driver's garbage is collected, but for those of its last job."""
        docs.sparkSession.sparkContext._jvm.System.gc()

    def read(batches: Iterator[pa.RecordBatch]) -> dict[int, list[tuple[bool, pa.Array, np.ndarray, list[bytes], pa.RecordBatch]]]:
        """Of each chunk: whether held out, words, texts' numbers of them, hashes of the texts, and the other columns."""
        texts: dict[int, list[tuple[bool, pa.Array, np.ndarray, list[bytes], pa.RecordBatch]]] = {}
        for batch in batches:
            where, out = batch.column(3).to_numpy(), pc.fill_null(batch.column(1), False).to_numpy(zero_copy_only=False)
            for at in np.unique(where).tolist():
                for held in (False, True):
                    own = batch.filter(pa.array((where == at) & (out == held)))
                    order = [blake2b(t.as_buffer(), digest_size=16).digest() for t in own.column(2)]
                    texts.setdefault(at, []).append((held, *_split(own.column(2)), order, own.select(["doc_id", "held_out"])))
        return texts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = read(batches)  # whose batches end there
        sub = subwords_of(path)
        for at in [*texts]:
            parts = sorted(texts.pop(at), key=lambda x: x[0])  # the training texts first
            found = pa.chunked_array([x[1] for x in parts if len(x[1])], pa.large_binary())
            coded = found.dictionary_encode().combine_chunks() if len(found) else pa.array([], pa.large_binary()).dictionary_encode()
            words = coded.dictionary
            flat, width = sub(words)
            ids = _packed(flat, width, sub.kind)
            train = sum(len(x[2]) for x in parts if not x[0])
            per = np.concatenate([x[2] for x in parts])
            order = [x for part in parts for x in part[3]]
            docs = pa.Table.from_batches([x[4] for x in parts]).append_column("hash", pa.array(order, pa.binary()))
            numbers = coded.indices.to_numpy()
            del parts, found, coded
            place = pc.sort_indices(docs, [("doc_id", "ascending"), ("hash", "ascending")]).to_numpy().astype(np.int64)  # batches that no shuffle changes
            docs = docs.take(place).combine_chunks()
            for a, b in spans(per[place], 65536, 1 << 18):
                some, (own, each) = docs.slice(a, b - a), _gather(numbers, per, place[a:b])
                low, high = _packed(own & 0xFFFF, each, HALF), _packed(own >> 16, each, HALF)
                yield _rows(at, a, n=some["doc_id"], ids=low, high=high, held=some["held_out"])
            del docs, place
            order, per = order[:train], per[:train]
            numbers = numbers[: int(per.sum())]
            number = np.bincount(numbers, minlength=len(words))
            seen = np.bincount(flat, weights=np.repeat(number, width), minlength=sub.end + 1).astype(np.int64)
            number = pa.array(number, pa.int64())
            for a in range(0, len(words), 65536):
                yield _rows(at, a, words=words[a : a + 65536], n=number[a : a + 65536], ids=ids[a : a + 65536])
            del words, ids, number
            pa.default_memory_pool().release_unused()
            numbers, per = _gather(numbers, per, np.array(sorted(range(len(order)), key=order.__getitem__), dtype=np.int64))  # an order that no shuffle changes
            ids, lengths = _all_spelled(numbers, per, flat, width, sub.end)
            del numbers, flat, width
            w = attention.train(attention.initial(), ids, lengths, sub.class_of, STEPS)
            total = np.concatenate((np.round(attention.pack(w).astype(np.float64) * UNIT).astype(np.int64), seen))
            yield _rows(at, -1, n=pa.nulls(1, pa.int64()), ids=pa.array([total.tobytes()], pa.binary()))

    def _rows(chunk: int, first: int, n, ids, words=None, high=None, held=None) -> pa.RecordBatch:
        """Rows numbered from ``first``: of words (``n`` are their counts), of documents (``n`` are their ids, ``ids`` and ``high``
        their words' numbers), or, as -1, the weights and counts of subwords."""
        size = len(n)
        column = lambda x, kind: pa.nulls(size, kind) if x is None else (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x).cast(kind)
        columns = {
            "chunk": pa.array(np.full(size, chunk, dtype=np.int32)),
            "at": pa.array(np.arange(first, first + size, dtype=np.int32)),
            "word": column(words, pa.binary()),
            "n": column(n, pa.int64()),
            "ids": column(ids, pa.binary()),
            "high": column(high, pa.binary()),
            "held_out": column(held, pa.bool_()),
        }
        return pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    local = written(
        dealt.repartitionById(chunks, F.col("chunk")).mapInArrow(count, "chunk int, at int, word binary, n bigint, ids binary, high binary, held_out boolean"),
        "words",
    )
    sub = subwords_of(path)
    totals = local.where("at < 0").select("ids")
    trained, totals = totals.count(), _sum(totals, chunks, attention.SIZE + sub.end + 1)
    weights = (totals[: attention.SIZE] / (trained * UNIT)).astype(np.float32) if trained else attention.pack(attention.initial())
    forget()
    same = Window.partitionBy("word")
    counted = written(
        local.where("word is not null").select("chunk", "at", "ids", F.sum("n").over(same).alias("c"), (F.col("chunk") == F.min("chunk").over(same)).alias("once")),
        "counts",
    )
    n, v = counted.where("once and c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n, v = n + n_train, v + (n_train > 0)
    forget()
    seen = np.zeros(sub.end + 2)
    seen[: sub.end + 1] = totals[attention.SIZE :]
    seen[sub.end] = n_train
    per_class = np.bincount(sub.class_of, weights=seen + 0.05, minlength=attention.CLASSES + 1)
    within = np.log((seen + 0.05) / per_class[sub.class_of])
    scale = n + 0.1 * (v + 1)

    def scored(docs: pa.Table, words: pa.Table) -> pa.Table:
        docs = docs.sort_by("at")
        sub = subwords_of(path)
        scorer = attention.Scorer(attention.unpack(weights), sub.class_of, within)
        c = words["c"].to_numpy().astype(np.float64)
        where = np.empty(len(c), dtype=np.int32)
        where[words["at"].to_numpy()] = np.arange(len(c))  # every number has its word
        numbers, per = _unpacked(docs["ids"].combine_chunks(), HALF)
        numbers |= _unpacked(docs["high"].combine_chunks(), HALF)[0] << 16
        at = where[numbers]
        flat, width = _unpacked(words["ids"].combine_chunks(), sub.kind)
        docs = docs.drop_columns(["ids", "high"])
        del numbers
        pa.default_memory_pool().release_unused()
        word_score = np.log10((c + 0.1) / scale)
        known = c > 0
        end_score, end_known = math.log10((n_train + 0.1) / scale), int(n_train > 0)
        edge = np.concatenate(([0], np.cumsum(per)))
        knowns, bases, models = [], [], []
        for span, ids, lengths in _spelled(at, per, flat, width, sub.end):
            own = at[edge[span.start] : edge[span.stop]]
            row = np.repeat(np.arange(len(lengths)), per[span])
            knowns.append(np.bincount(row, weights=known[own], minlength=len(lengths)).astype(np.int64) + end_known)
            bases.append(np.bincount(row, weights=word_score[own], minlength=len(lengths)) + end_score)
            models.append(scorer(ids, lengths) / math.log(10))
        column = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.table(
            {
                "doc_id": docs["n"],
                "held_out": docs["held_out"],
                "n_tokens": pa.array(per + 1, pa.int64()),
                "n_known": column(knowns, pa.int64()),
                "train_tokens": pa.array(np.full(docs.num_rows, n, dtype=np.int64)),
                "base_score": column(bases, pa.float64()),
                "score": column(models, pa.float64()),
            }
        )

    # A partition per chunk on both sides: no two chunks ever fall together in one task.
    return (
        local.where("high is not null").select("chunk", "at", "n", "ids", "high", "held_out").repartitionById(chunks, F.col("chunk"))
        .groupBy("chunk")
        .cogroup(counted.select("chunk", "at", "ids", "c").repartitionById(chunks, F.col("chunk")).groupBy("chunk"))
        .applyInArrow(
            scored,
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        )
    )
