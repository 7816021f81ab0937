"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed here (no generated classes), and a pipeline with the same results
is rebuilt from it: the normaliser (character map, extra spaces, dummy prefix), the metaspace
marker, the pieces with their scores (as a unigram model, or as merges in score order for a BPE
model), byte fallback, and the decoder.

Where no piece has a marker behind another character, a text's encoding is the concatenation of
those of its units (a run of markers and what follows up to the next). Each batch is then cut
into units, and only the distinct ones are encoded and decoded, in one multithreaded call. Parity
is verified on every distinct unit against the sentencepiece library, and the ids of a unit that
differs (equal scores can merge in another order) are the library's. Models without that property are encoded by
whole texts in the same way.

A null or empty text has no ids and decodes to the empty text. ``round_trip`` tells if the decoded
text equals the input (the marker itself, written in a text, comes back as a space). Rows are
independent; other columns aren't read.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from .common import pieces, strings

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Distinct units that a task remembers before it starts anew; bounds its memory.
REMEMBERED = 200_000
#: Units that are encoded as one text.
GROUP = 64


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at : at + size]
            at += size


@dataclass
class Proto:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True


def parse(data: bytes) -> Proto:
    proto = Proto()
    for number, value in fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    text = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            proto.pieces.append((text, score, kind))
        elif number == 2:
            for n, v in fields(value):
                if n == 3:
                    proto.model_type = v
                elif n == 35:
                    proto.byte_fallback = bool(v)
                elif n == 40:
                    proto.unk_id = v
        elif number == 3:
            for n, v in fields(value):
                if n == 2:
                    proto.charsmap = v
                elif n == 3:
                    proto.add_dummy_prefix = bool(v)
                elif n == 4:
                    proto.remove_extra_whitespaces = bool(v)
                elif n == 5:
                    proto.escape_whitespaces = bool(v)
    return proto


def rebuild(proto: Proto, prefix: bool = True):
    """A Tokenizer with the model's results; ``prefix`` False leaves out the dummy prefix."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    names = [p for p, _, _ in proto.pieces]
    if proto.model_type == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in proto.pieces], proto.unk_id, proto.byte_fallback)
    elif proto.model_type == BPE:
        ids = {p: i for i, (p, _, kind) in enumerate(proto.pieces) if kind in (NORMAL, USER)}
        merges = []
        for piece, score, kind in proto.pieces:
            if kind == NORMAL and len(piece) > 1:
                for cut in range(1, len(piece)):
                    left, right = piece[:cut], piece[cut:]
                    if left in ids and right in ids:
                        merges.append((-score, ids[piece], ids[left], ids[right], (left, right)))
        model = models.BPE(
            {p: i for i, p in enumerate(names)},
            [m[-1] for m in sorted(merges)],
            unk_token=names[proto.unk_id],
            fuse_unk=True,
            cache_capacity=0,
            byte_fallback=proto.byte_fallback,
        )
    else:
        raise ValueError(f"model type {proto.model_type} has no equivalent")
    tokenizer = Tokenizer(model)
    steps = [normalizers.Precompiled(proto.charsmap)] if proto.charsmap else []
    if proto.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if proto.add_dummy_prefix and prefix:
        steps.append(normalizers.Prepend(MARK if proto.escape_whitespaces else " "))
    if proto.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer


class Codec:
    """Batches of texts to ids and back."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            self.proto = parse(f.read())
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        p = self.proto
        self.by_unit = (
            p.escape_whitespaces
            and p.add_dummy_prefix
            and not p.remove_extra_whitespaces
            and not p.charsmap
            and not any(MARK in x.lstrip(MARK) for x, _, _ in p.pieces)
        )
        self.tokenizer = rebuild(p, prefix=not self.by_unit)
        self.differ = 0
        self.width = np.array([1 if kind == BYTE else len(x.encode()) for x, _, kind in p.pieces], dtype=np.int64)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.size = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)
        self.faithful = np.zeros(0, dtype=bool)

    def units(self, text: str) -> list[str]:
        """The text's units, marker for space, the dummy prefix added."""
        if not text:
            return []
        if not self.by_unit:
            return [text]
        marked = MARK + text.replace(" ", MARK)
        parts = marked.split(MARK)[1:]
        if "" not in parts:
            return [MARK + x for x in parts]
        return re.findall(f"{MARK}+[^{MARK}]*", marked)

    def _surface(self, unit: str) -> str:
        return unit.replace(MARK, " ") if self.by_unit else unit

    def _learn(self, new: list[str]) -> None:
        """Encode, verify and decode units that are new, many at a time: a group's text is that of
        its units in a row, so its ids are theirs, told apart by the bytes that each id stands for."""
        got: list[np.ndarray] = []
        good: list[bool] = []
        step = GROUP if self.by_unit else 1
        groups = [new[at : at + step] for at in range(0, len(new), step)]
        joined = ["".join(g) for g in groups]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        plain = [t[1:].replace(MARK, " ") for t in joined] if self.by_unit else joined
        wanted = self.sp.encode(plain, num_threads=2)
        back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        for group, text, own, theirs, decoded, flat in zip(groups, joined, ids, wanted, back, plain):
            whole = np.asarray(own, dtype=np.int32)
            if self.by_unit and own == theirs and decoded == self._surface(text):
                ends = np.cumsum(self.width[whole])
                cuts = np.cumsum([len(u.encode()) for u in group])
                at = np.searchsorted(ends, cuts) + 1
                if len(ends) and ends[-1] == cuts[-1] and (ends[at - 1] == cuts).all():
                    got += np.split(whole, at[:-1])
                    good += [True] * len(group)
                    continue
            for unit in group:
                one = self.tokenizer.encode(unit, add_special_tokens=False).ids
                text = unit[1:].replace(MARK, " ") if self.by_unit else unit
                library = self.sp.encode(text)
                if one != library and text:  # the library has no text that is the dummy prefix alone
                    self.differ += 1
                    one = library
                text = self.tokenizer.decode(one, skip_special_tokens=False)
                if not self.by_unit and self.proto.add_dummy_prefix and text.startswith(" "):
                    text = text[1:]
                got.append(np.asarray(one, dtype=np.int32))
                good.append(text == self._surface(unit))
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.size = np.append(self.size, np.fromiter(map(len, got), dtype=np.int64, count=len(got)))
        self.flat = np.concatenate([self.flat, *got])
        self.faithful = np.append(self.faithful, np.array(good, dtype=bool))

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """Flat ids, the number of each text's ids, and whether they decode to the text."""
        if len(self.index) > REMEMBERED:
            self.forget()
        cut = [self.units(t) for t in texts]
        known = self.index
        new = [u for u in dict.fromkeys(chain.from_iterable(cut)) if u not in known]
        if new:
            self._learn(new)
        per_text = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        at = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=int(per_text.sum()))
        begin = np.cumsum(self.size) - self.size
        own = self.size[at]
        total = int(own.sum())
        flat = self.flat[np.repeat(begin[at] - (np.cumsum(own) - own), own) + np.arange(total)]
        edge = np.concatenate(([0], np.cumsum(per_text)))
        ids_edge = np.concatenate(([0], np.cumsum(own)))[edge]
        wrong = np.concatenate(([0], np.cumsum(~self.faithful[at])))[edge]
        marks = (self.by_unit and MARK in t for t in texts)
        return flat, np.diff(ids_edge), [not w and not m for w, m in zip(np.diff(wrong).tolist(), marks)]


@lru_cache(maxsize=2)
def codec_of(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_ids, ids and round_trip of every whole text; one map over the table, no shuffle."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in pieces(batches, 1024, text=1):
            texts = strings(batch.column(1))
            flat, size, back = codec.batch(texts)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), ids, pa.array(back, pa.bool_())],
                names=["doc_id", "n_ids", "ids", "round_trip"],
            )

    return docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(
        run, "doc_id bigint, n_ids bigint, ids array<int>, round_trip boolean"
    )


def decode(encoded: DataFrame, model: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids; a null list decodes to the empty text."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in pieces(batches, 128):
            texts = codec.tokenizer.decode_batch([x or [] for x in batch.column(1).to_pylist()], skip_special_tokens=False)
            if codec.proto.add_dummy_prefix:
                texts = [t[1:] if t.startswith(" ") else t for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{ids_col}` as array<int>) ids").mapInArrow(
        run, "doc_id bigint, text string"
    )
