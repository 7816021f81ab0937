"""Token counts by overlap resynchronisation.

A text up to ``chunk`` bytes is encoded by the library as it is. A longer one is encoded in
chunks that overlap. Every chunk's encoding comes with the byte offset of each token boundary,
and two neighbours are spliced where both have a boundary at the same place and that place is
proven stable: a space begins there, the character before it is no space, and the vocabulary
(checked when the model is loaded) has no piece in which a space follows another character, so
no merge can ever cross it and the tokens on each side are those of the whole text. Where the
overlap holds no such place it is doubled, down to the last splice; where that isn't enough
either, the chunk itself is widened, up to the rest of the text. The count is therefore that of
the library for the whole text, while no encoding but one without any word boundary grows with
the document.

Nulls count as empty texts, which have 0 tokens; repeated rows are counted each; an empty table
gives an empty result. Only the id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from .common import pieces, strings

SPACE = "▁"
CHUNK = 32_768
OVERLAP = 512


class Encoder:
    """A SentencePiece model with what splicing needs: bytes per token, and whether it is safe."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        sp = self.sp
        names = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        self.width = np.array(
            [1 if sp.is_byte(i) else len(p.replace(SPACE, " ").encode()) for i, p in enumerate(names)],
            dtype=np.int64,
        )
        #: No piece has a space after another character, and spaces come through unchanged.
        self.safe = not any(SPACE in p.lstrip(SPACE) for p in names) and (
            sp.decode(sp.encode("a  b ")) == "a  b "
        )

    def ids(self, text: str) -> np.ndarray:
        return np.asarray(self.sp.encode(text, num_threads=1), dtype=np.int64)

    def bounds(self, data: bytes) -> np.ndarray | None:
        """Byte offsets where a token begins, or None if they can't be told from the pieces."""
        ends = np.cumsum(self.width[self.ids(data.decode())]) - 1  # the first space is added
        if not len(ends) or ends[-1] != len(data):
            return None
        return np.concatenate(([0], ends[:-1]))


def _starts(data: bytes, lo: int, hi: int) -> np.ndarray:
    """Stable places within (lo, hi)."""
    view = np.frombuffer(data, dtype=np.uint8)[lo:hi]
    return np.flatnonzero((view[1:] == 32) & (view[:-1] != 32)) + lo + 1


def _floor(data: bytes, at: int) -> int:
    """The start of the character that holds byte ``at``."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def count_long(encoder: Encoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text, encoded in overlapping chunks."""
    whole = lambda: len(encoder.ids(text))
    if not encoder.safe:
        return whole()
    data = text.encode()
    total, done, begin, end = 0, 0, 0, _floor(data, min(chunk, len(data)))
    bounds = encoder.bounds(data[begin:end])
    if bounds is None:
        return whole()
    bounds = bounds + begin
    while end < len(data):
        width, splice = overlap, None
        while splice is None:
            start = _floor(data, max(done, end - width))
            nxt = _floor(data, min(len(data), start + max(chunk, 2 * (end - start))))
            stable = _starts(data, start, end)
            if len(stable):
                other = encoder.bounds(data[start:nxt])
                if other is None:
                    return whole()
                other = other + start
                both = np.intersect1d(np.intersect1d(stable, bounds), other)
                if len(both):
                    splice = int(both[-1])
                    break
            if start == done:  # no stable place since the last splice: widen the chunk itself
                end = _floor(data, min(len(data), done + 2 * (end - done) + 4))
                bounds = encoder.bounds(data[begin:end])
                if bounds is None:
                    return whole()
                bounds = bounds + begin
                width = overlap
                if end == len(data):
                    break
            else:
                width *= 2
        if splice is None:
            break
        total += int(np.searchsorted(bounds, splice) - np.searchsorted(bounds, done))
        begin, end, bounds, done = start, nxt, other, splice
    return total + int(len(bounds) - np.searchsorted(bounds, done))


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    return Encoder(path)


def count_tokens(
    docs: DataFrame,
    model: str | None = None,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text; one map over the table, no shuffle."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in pieces(batches, text=1):
            texts = strings(batch.column(1))
            size = np.array([len(t) if t.isascii() else len(t.encode()) for t in texts], dtype=np.int64)
            tokens = np.zeros(len(texts), dtype=np.int64)
            short = np.flatnonzero(size <= chunk)
            if len(short):
                tokens[short] = [len(x) for x in encoder.sp.encode([texts[i] for i in short], num_threads=1)]
            for i in np.flatnonzero(size > chunk):
                tokens[i] = count_long(encoder, texts[i], chunk, overlap)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
