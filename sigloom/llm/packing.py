"""Best-fit packing by bin completion.

1. One map tokenises every text and cuts documents longer than a sequence (the remainder is the
   first piece). It emits a row per piece with its rank among the pieces of the same length in
   its task, and is written once: tokenising isn't repeated.
2. Only the histogram of lengths (at most ``size`` numbers, whatever the corpus) reaches the
   driver. There bin completion runs on lengths with multiplicities: take the largest length
   left, enumerate the undominated fillings of the space beside it, try them by least waste,
   prune a branch when its waste exceeds what one sequence less than the incumbent would allow,
   and stop at the lower bound. Best-fit decreasing gives the first incumbent. A filling is
   applied as often as the counts allow, so that the work depends on the number of distinct
   lengths, not on the number of documents.
3. The result is a table of runs (length, first rank, copies, sequence, offset), at most a few
   thousand rows for any corpus. Each piece finds its run by its rank: per task and length the
   first rank is a running sum over (task, length) counts, so that a length which a third of all
   pieces share is still spread over all tasks.

Null texts count as empty (one token, the end); ties and repeated rows are packed each on its own
rank; an empty table gives no rows. Other columns aren't read.
"""

from __future__ import annotations

import base64
import json
import math
import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from tokenizers import Tokenizer

from .common import pieces, strings, written

SIZE = 2048
#: The dives: finished packings that are looked for, fillings tried per sequence, nodes of one enumeration, nodes at least.
DIVES, WIDTH, FILL_NODES, NODES = 4, 3, 400, 1200
#: The exact search: steps of all its enumerations and of what it copies, together.
EXACT_STEPS = 100_000

Run = tuple[int, int, int, int, int, int]


# --- tokens -----------------------------------------------------------------------------------


class Ids:
    """Ids of the byte-level BPE file, special strings in a text handled as the library does.

    The merges run in tiktoken when it holds the same vocabulary (``.tiktoken`` beside the
    ``.json``), as it is several times faster; tests hold the ids of both against each other.
    """

    def __init__(self, path: str):
        self.fast = self.slow = None
        ranks_path = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks_path):
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            with open(path, encoding="utf-8") as f:
                special = {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}
            self.fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.special = set(special)
        else:
            self.slow = Tokenizer.from_file(path)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None:
            return self.fast.encode_to_numpy(text, allowed_special=self.special).astype("<u4", copy=False)
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=2)
def ids_of(path: str) -> Ids:
    return Ids(path)


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; only the first may be shorter."""
    head = n % size or size
    return [(0, min(head, n)), *((at, size) for at in range(head, n, size))]


# --- bin completion ---------------------------------------------------------------------------


def lower_bound(counts: dict[int, int], size: int) -> int:
    """Sequences that any packing needs: the best of the continuous bound and those with large items apart."""
    lengths = sorted(counts)
    best = -(-sum(n * c for n, c in counts.items()) // size)
    for k in {0, *(n for n in lengths if n <= size // 2)}:
        large = sum(c for n, c in counts.items() if n > size - k)
        middle = sum(c for n, c in counts.items() if size // 2 < n <= size - k)
        space = middle * size - sum(n * c for n, c in counts.items() if size // 2 < n <= size - k)
        small = sum(n * c for n, c in counts.items() if k <= n <= size // 2)
        best = max(best, large + middle + max(0, -(-(small - space) // size)))
    return best


def fillings(lengths: list[int], counts: dict[int, int], room: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Fillings of ``room``, least waste first and larger items first among equals.

    Copies of one length are taken together, as many as fit first. A filling is dominated, and
    not listed, if another item that is left would still fit into its waste.
    """
    found: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    nodes = 0

    def go(at: int, room: int, taken: tuple[tuple[int, int], ...]) -> bool:
        """True once enough is known: WIDTH fillings without waste, or the nodes are used up."""
        nonlocal nodes
        nodes += 1
        at = bisect_right(lengths, room, 0, at)
        if room == 0 or at == 0:
            found.append((room, taken))
            return nodes > FILL_NODES or sum(w == 0 for w, _ in found) >= WIDTH
        for i in range(at - 1, -1, -1):
            n = lengths[i]
            most = min(counts[n], room // n)
            for k in range(most, 0, -1) if i == at - 1 or most < 4 else (most,):
                if go(i, room - k * n, (*taken, (n, k))):
                    return True
            if nodes > FILL_NODES:
                return True
            if any(w == 0 for w, _ in found) and i < at - 3:
                break
        return False

    go(len(lengths), room, ())
    out: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    for waste, taken in sorted(found, key=lambda f: (f[0], [(-n, -k) for n, k in f[1]])):
        used = dict(taken)
        if not any(counts[n] > used.get(n, 0) for n in lengths[: bisect_right(lengths, waste)]):
            out.append((waste, taken))
            if len(out) == WIDTH:
                break
    return out or found[:1]


Pattern = tuple[tuple[tuple[int, int], ...], int]


def best_fit(counts: dict[int, int], size: int) -> list[Pattern]:
    """Best-fit decreasing on multiplicities: the first incumbent."""
    left, out = dict(counts), []
    lengths = sorted(left)
    while lengths:
        pattern, room = [], size
        while room and (at := bisect_right(lengths, room)):
            n = lengths[at - 1]
            used = dict(pattern).get(n, 0)
            k = min(left[n] - used, room // n)
            pattern.append((n, k))
            room -= n * k
            lengths = lengths[: at - 1] + lengths[at:]
        times = min(left[n] // k for n, k in pattern)
        out.append((tuple(pattern), times))
        for n, k in pattern:
            left[n] -= k * times
        lengths = sorted(n for n, c in left.items() if c)
    return out


def bin_completion(counts: dict[int, int], size: int = SIZE) -> tuple[list[Pattern], int]:
    """Patterns with multiplicities, and the number of sequences that no packing can do without.

    First dives, whose work depends on the number of different lengths: each filling is applied as
    often as the counts allow, WIDTH fillings of a space are tried, and the search ends after DIVES
    finished packings, or twice the nodes that a packing takes (NODES at least). Then, if the lower bound isn't reached, the
    exact search of ``completed``. The result is optimal if its sequences equal the number
    returned; else it is the best incumbent.
    """
    counts = {n: c for n, c in counts.items() if c}
    bound = lower_bound(counts, size)
    best = best_fit(counts, size)
    fewest = sum(times for _, times in best)
    total = sum(n * c for n, c in counts.items())
    nodes = dives = 0
    most = max(NODES, 2 * len(best))
    # What waits is kept as small arrays and as links to the patterns before, as thousands may wait.
    packed = lambda left: np.array(list(left.items()), dtype=np.int64).reshape(-1, 2)
    stack = [(packed(counts), None, 0, 0)]
    while stack and fewest > bound and dives < DIVES and nodes < most:
        waiting, made, used, waste = stack.pop()
        left = dict(waiting.tolist())
        nodes += 1
        if not left:
            dives += 1
            if used < fewest:
                best, fewest = [], used
                while made is not None:
                    pattern, made = made
                    best.append(pattern)
                best.reverse()
            continue
        lengths = sorted(left)
        top = lengths[-1]
        left1 = {**left, top: left[top] - 1}
        options = fillings([n for n in lengths if left1[n]], left1, size - top)
        for room, filling in reversed(options):  # the least waste is popped first
            merged: dict[int, int] = {top: 1}
            for n, k in filling:
                merged[n] = merged.get(n, 0) + k
            times = min(left[n] // k for n, k in merged.items())
            if waste + room * times > (fewest - 1) * size - total:
                times = max(1, min(times, ((fewest - 1) * size - total - waste) // max(1, room)))
                if waste + room * times > (fewest - 1) * size - total:
                    continue
            rest = {n: c - merged.get(n, 0) * times for n, c in left.items()}
            stack.append((packed({n: c for n, c in rest.items() if c}), ((tuple(merged.items()), times), made), used + times, waste + room * times))
    del stack
    if fewest > bound:
        found, proven = completed(counts, size, fewest, bound)
        if found is not None:
            best, fewest = found, sum(times for _, times in found)
        if proven:
            bound = fewest
    return best, bound


def completed(counts: dict[int, int], size: int, fewest: int, bound: int) -> tuple[list[Pattern] | None, bool]:
    """A packing of less than ``fewest`` sequences, if one was found, and whether there is none better.

    Branch and bound over one sequence at a time: every undominated filling around the largest
    length left is enumerated and tried, least waste first; a branch ends when its waste, or the
    lower bound of what is left, reaches the incumbent. Within EXACT_STEPS the answer is exact.
    """
    total = sum(n * c for n, c in counts.items())
    best, steps = None, 0
    seen: dict[tuple, int] = {}

    def undominated(left: dict[int, int], room: int, spare: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
        nonlocal steps
        lengths = sorted(n for n in left if left[n] and n <= room)
        steps += len(left)
        below = [0]
        for n in lengths:
            below.append(below[-1] + n * left[n])
        out, todo = [], [(len(lengths), room, (), room + 1)]
        while todo and steps < EXACT_STEPS:
            at, space, taken, smallest = todo.pop()  # smallest: the least length of which some were left out
            steps += 1
            if space - below[at] > spare:
                continue
            if at == 0:
                if smallest > space:  # else it still fits: dominated
                    out.append((space, taken))
                continue
            n = lengths[at - 1]
            most = min(left[n], space // n)
            steps += most
            for k in range(most + 1):
                todo.append((at - 1, space - k * n, (*taken, (n, k)) if k else taken, smallest if k == left[n] else n))
        return sorted(out, key=lambda f: (f[0], [(-n, -k) for n, k in f[1]]))

    def children(left, waste):
        top = max(left)
        rest = {**left, top: left[top] - 1}
        for room, filling in undominated(rest, size - top, (fewest - 1) * size - total - waste):
            merged = {top: 1}
            for n, k in filling:
                merged[n] = merged.get(n, 0) + k
            yield room, tuple(merged.items()), {n: c - merged.get(n, 0) for n, c in left.items() if c > merged.get(n, 0)}

    made: list[Pattern] = []
    stack = [(children(counts, 0), 0)]
    while stack and fewest > bound and steps < EXACT_STEPS:
        options, waste = stack[-1]
        step = next(options, None)
        if step is None:
            stack.pop()
            if made:
                made.pop()
            continue
        room, pattern, left = step
        used = len(made) + 1
        if waste + room > (fewest - 1) * size - total:
            continue
        if not left:
            if used < fewest:
                best, fewest = [*made, (pattern, 1)], used
            continue
        steps += 2 * len(left)
        state = tuple(sorted(left.items()))
        least = lower_bound(left, size) if len(left) <= 64 else -(-sum(n * c for n, c in left.items()) // size)
        steps += len(left) ** 2 if len(left) <= 64 else 0
        if used + least >= fewest or seen.get(state, math.inf) <= used:
            continue
        seen[state] = used
        made.append((pattern, 1))
        stack.append((children(left, waste + room), waste + room))
    return best, fewest <= bound or (not stack and steps < EXACT_STEPS)


def runs_of(patterns: list[Pattern]) -> list[Run]:
    """(length, first rank, pieces, copies per sequence, first sequence, offset of the first copy)."""
    out, rank, sequence = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for n, k in pattern:
            first = rank.get(n, 0)
            out.append((n, first, k * times, k, sequence, offset))
            rank[n] = first + k * times
            offset += n * k
        sequence += times
    return sorted(out)


# --- the operator -----------------------------------------------------------------------------


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    size: int = SIZE,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = ids_of(path), TaskContext.get().partitionId()
        rank = np.zeros(size + 1, dtype=np.int64)
        end = np.array([end_id], dtype="<u4")
        for batch in pieces(batches, text=1):
            owner, rows = [], []
            for i, text in enumerate(strings(batch.column(1))):
                ids = np.concatenate((encode(text), end))
                for piece, (start, length) in enumerate(cut(len(ids), size)):
                    owner.append(i)
                    rows.append((piece, start, length, zlib.crc32(ids[start : start + length].tobytes()), rank[length]))
                    rank[length] += 1
            columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner, pa.int64())),
                    pa.array(columns[0].astype(np.int32)),
                    *(pa.array(c) for c in columns[1:]),
                    pa.array(np.full(len(rows), task, dtype=np.int32)),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "rank", "task"],
            )

    cuts = written(
        docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(
            tokenise, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, rank bigint, task int"
        ),
        "pieces",
    )
    per_task = cuts.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    patterns, _ = bin_completion(histogram, size)
    runs = np.array(runs_of(patterns), dtype=np.int64).reshape(-1, 6)
    key = runs[:, 0] << 44 | runs[:, 1]  # sorted by length, then rank

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = runs[np.searchsorted(key, length << 44 | rank, side="right") - 1]
            nth = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(run[:, 4] + nth // run[:, 3]), pa.array(run[:, 5] + nth % run[:, 3] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    order = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = per_task.select(
        F.col("length").alias("l"), F.col("task").alias("t"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("first")
    )
    ranked = cuts.join(first, (F.col("length") == F.col("l")) & (F.col("task") == F.col("t"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("first")).alias("rank")
    )
    return ranked.mapInArrow(
        place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
