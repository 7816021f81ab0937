"""Exact inner-product top-k by ball trees.

The rows are spread over shards of bounded size; each shard is packed into one row and gets a ball
tree. The queries are packed into blocks of bounded size, and every block meets every shard. A
block's shards are dealt to lanes, and block, lane and length are the key of the join, so that no
key holds more than one lane. A task works through a lane's shards one after the other and carries
the block's current k-th scores along, so that each tree starts with the bounds that the trees
before it found. In a tree the child with the larger upper bound (query . centre + |query| *
radius) is entered first, per query, and a node is left out for the queries whose k-th score
exceeds its bound. A node that reaches the bound is still entered, as a tie may go to a smaller id.
Results of the tasks of a block, k rows per query each, are merged at the end.

Scores are exact: components are integers; where every partial sum is below 2**53 products are
summed in double, otherwise doubles only rule rows out (by a bound on their error), and the
others' scores are Python integers. Ranks are those of the exact scores; one beyond 64 bits is
returned as the nearest 64-bit integer. Rows whose vector is null or empty, or holds a null or
non-finite component, take no part; any finite size does. A query meets the vectors of its own
length only. A row isn't a candidate for queries of the same id. Repeated rows are candidates each;
rows without an id take no part. An empty table, or one without queries, gives no rows; one with
few rows gives all. Other columns aren't read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARD_ROWS, BLOCK_ROWS, LEAF = 8192, 4096, 128


class BallTree:
    """Nodes over rows that are permuted so that each node's rows are consecutive."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(x))
        self.nodes: list[tuple[int, int, int, int]] = []  # first row, end, left child, right child
        centres, radii = [], []
        todo = [(0, len(x), -1, 0)] if len(x) else []
        while todo:
            a, b, parent, side = todo.pop()
            own = x[self.order[a:b]]
            centre = own.mean(axis=0)
            away = np.sqrt(((own - centre) ** 2).sum(axis=1))
            me = len(self.nodes)
            self.nodes.append((a, b, -1, -1))
            centres.append(centre)
            radii.append(away.max())
            if parent >= 0:
                f, e, left, right = self.nodes[parent]
                self.nodes[parent] = (f, e, me, right) if side == 0 else (f, e, left, me)
            if b - a > leaf and away.max() > 0:
                one = own[away.argmax()]
                two = own[((own - one) ** 2).sum(axis=1).argmax()]
                along = own @ (two - one)
                half = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(along, half)]
                todo += [(a, a + half, me, 0), (a + half, b, me, 1)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.x = x[self.order]


def search(tree: BallTree, ids: np.ndarray, q: np.ndarray, qid: np.ndarray, best: np.ndarray, best_id: np.ndarray, whole: bool, integer_q=None, integer_x=None) -> None:
    """Improve ``best`` and ``best_id`` (k columns, best first) by the tree's rows; ids are in its order.

    Unless ``whole`` (sums of products are exact in double), ``best`` holds Python integers, and
    ``integer_q`` and ``integer_x`` give the components of a query and of a row as integers.
    """
    if not len(tree.nodes) or not len(q):
        return
    k = best.shape[1]
    norm = np.sqrt((q * q).sum(axis=1))
    slack = 1e-6 + 1e-9 * norm * np.sqrt((tree.x * tree.x).sum(axis=1)).max()
    floor = best[:, -1].copy() if whole else np.array([below(s) for s in best[:, -1]])

    def bound(node: int, who: np.ndarray) -> np.ndarray:
        return q[who] @ tree.centres[node] + norm[who] * tree.radii[node] + slack[who]

    todo = [(0, np.arange(len(q)), None)]
    while todo:
        node, who, upper = todo.pop()
        upper = bound(node, who) if upper is None else upper
        who = who[~(upper < floor[who])]  # also what is too large for a double
        if not len(who):
            continue
        a, b, left, right = tree.nodes[node]
        if left >= 0:
            ub_l, ub_r = bound(left, who), bound(right, who)
            first = ub_l >= ub_r
            # last in, first out: everyone enters the better child first
            for child, mask, ub in ((left, ~first, ub_l), (right, first, ub_r), (right, ~first, ub_r), (left, first, ub_l)):
                if mask.any():
                    todo.append((child, who[mask], ub[mask]))
            continue
        scores = q[who] @ tree.x[a:b].T
        own = np.broadcast_to(ids[a:b], scores.shape)
        scores = np.where(own == qid[who, None], -np.inf, scores)
        if whole:
            better = (scores >= best[who, -1:]).any(axis=1)
            who, scores, own = who[better], scores[better], own[better]
            if len(who):
                all_s, all_i = np.hstack((best[who], scores)), np.hstack((best_id[who], own))
                at = np.lexsort((all_i, -all_s), axis=-1)[:, :k]
                best[who], best_id[who] = np.take_along_axis(all_s, at, 1), np.take_along_axis(all_i, at, 1)
                floor[who] = best[who, -1]
            continue
        for row, me in enumerate(who):
            near = np.flatnonzero(~(scores[row] + slack[me] < floor[me]) & (own[row] != qid[me]))
            found = [(best[me, j], best_id[me, j]) for j in range(k)]
            found += [(exact(integer_q(me), integer_x(tree.order[a + j])), own[row, j]) for j in near]
            found = sorted(found, key=lambda f: (-f[0], f[1]))[:k]
            for j, (score, i) in enumerate(found):
                best[me, j], best_id[me, j] = score, i
            floor[me] = below(best[me, -1])


def below(score) -> float:
    """A double that isn't above the score."""
    if abs(score) >= 2**1000:
        return -math.inf if score < 0 else 2.0**1000
    return float(score) - 1e-15 * abs(float(score))


def integers(row: np.ndarray, scale: float) -> list[int]:
    """The scaled components of a row of doubles."""
    return [math.floor(s) if math.isfinite(s := scale * x) else math.floor(x) * math.floor(scale) for x in row.tolist()]


def exact(a: list[int], b: list[int]) -> int:
    return sum(map(int.__mul__, a, b))


def order_key(score: int) -> bytes | None:
    """For scores at the ends of 64 bits or beyond: bytes that sort as the scores do."""
    if -(1 << 63) < score < (1 << 63) - 1:
        return None
    raw = abs(score).to_bytes(260, "big")
    return b"\1" + raw if score > 0 else b"\0" + bytes(255 - c for c in raw)


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows where the column ``is_query`` (over vec_id) holds."""

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_id, out_dim, out_wide, out = [], [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)):
                if i is None or v is None or not len(v):
                    continue
                v = np.asarray(v, dtype=np.float64)  # a null component comes as NaN
                if not np.isfinite(v).all():
                    continue
                with np.errstate(over="ignore"):
                    scaled = np.floor(scale * v)
                wide = bool(np.abs(scaled).max() >= 2**31)
                out_id.append(i)
                out_dim.append(len(v))
                out_wide.append(wide)
                out.append((v.astype("<f8") if wide else scaled.astype("<i4")).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_id, pa.int64()), pa.array(out_dim, pa.int32()), pa.array(out_wide, pa.bool_()), pa.array(out, pa.binary())],
                names=["vec_id", "dim", "wide", "v"],
            )

    rows = written(
        vectors.selectExpr(f"cast(`{id_col}` as bigint) vec_id", f"cast(`{vector_col}` as array<double>) v").mapInArrow(
            quantise, "vec_id bigint, dim int, wide boolean, v binary"
        ),
        "vectors",
    ).withColumn("is_query", is_query)
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(n_queries / block_rows))

    def packed(part: str):
        def run(table: pa.Table) -> pa.Table:
            table = table.combine_chunks()
            return pa.table(
                {
                    part: pa.array([table[part][0].as_py()], pa.int64()),
                    "dim": pa.array([table["dim"][0].as_py()], pa.int32()),
                    "wide": pa.array([table["wide"][0].as_py()], pa.bool_()),
                    "ids": pa.array([table["vec_id"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                    "vs": pa.array([b"".join(table["v"].to_pylist())], pa.binary()),
                }
            )

        return run

    place = F.xxhash64("vec_id", "v")  # rows that share an id and a vector alone fall together
    shard = (
        rows.withColumn("shard", F.pmod(place, F.lit(shards)))
        .groupBy("shard", "dim", "wide")
        .applyInArrow(packed("shard"), "shard bigint, dim int, wide boolean, ids binary, vs binary")
    )
    block = (
        rows.where("is_query")
        .withColumn("block", F.pmod(place, F.lit(blocks)))
        .groupBy("block", "dim", "wide")
        .applyInArrow(packed("block"), "block bigint, dim int, wide boolean, ids binary, vs binary")
        .withColumnsRenamed({"ids": "q_ids", "vs": "qs", "wide": "q_wide"})
    )
    # A block's shards are dealt to lanes; one task per block and lane takes them in turn. Both sides are
    # partitioned for the join as the search wants them, so that nothing moves a second time.
    lanes = max(1, min(shards, math.ceil(64 / blocks)))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    key = ["block", "lane", "dim"]
    met = (
        shard.withColumn("lane", F.pmod("shard", F.lit(lanes)))
        .withColumn("block", every(blocks))
        .repartition(blocks * lanes, *key)
        .join(block.withColumn("lane", every(lanes)).repartition(blocks * lanes, *key).hint("shuffle_hash"), key)
        .sortWithinPartitions(*key, "q_wide", "shard", "wide")
    )

    def values(raw: bytes, wide: bool, dim: int) -> tuple[np.ndarray, np.ndarray]:
        stored = np.frombuffer(raw, dtype="<f8" if wide else "<i4").reshape(-1, dim).astype(np.float64)
        with np.errstate(over="ignore"):
            return stored, np.floor(scale * stored) if wide else stored

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, at = None, None

        def result():
            qid, pos, best, best_id = state
            there = best > -np.inf
            row, col = np.nonzero(there)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(row), at[0], dtype=np.int64)),
                    pa.array(np.full(len(row), at[2], dtype=np.int32)),
                    pa.array(np.full(len(row), at[3], dtype=bool)),
                    pa.array(pos[row]),
                    pa.array(qid[row]),
                    pa.array(best_id[row, col].astype(np.int64)),
                    pa.array([min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in best[row, col]], pa.int64()),
                    pa.array([order_key(int(x)) for x in best[row, col]], pa.binary()),
                ],
                names=["block", "dim", "q_wide", "pos", "query_id", "vec_id", "score", "key"],
            )

        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i].as_py()  # noqa: B023, E731
                key, dim = (get("block"), get("lane"), get("dim"), get("q_wide")), get("dim")
                if key != at:
                    if state is not None:
                        yield result()
                    at = key
                    qid = np.frombuffer(get("q_ids"), dtype="<i8")
                    raw_q, q = values(get("qs"), get("q_wide"), dim)
                    state = (qid, np.arange(len(qid)), np.full((len(qid), k), -np.inf), np.full((len(qid), k), np.iinfo(np.int64).max))
                ids = np.frombuffer(get("ids"), dtype="<i8")
                raw_x, x = values(get("vs"), get("wide"), dim)
                with np.errstate(over="ignore", invalid="ignore"):
                    whole = state[2].dtype != object and bool(dim * np.abs(q).max() * np.abs(x).max() < 2**53)
                    if not whole and state[2].dtype != object:
                        kept = np.array([[int(s) if np.isfinite(s) else -np.inf for s in row] for row in state[2]], dtype=object)
                        state = (state[0], state[1], kept.reshape(state[2].shape), state[3])
                    tree = BallTree(x)
                    search(
                        tree, ids[tree.order], q, qid, state[2], state[3], whole,
                        lambda i, wide=get("q_wide"): integers(raw_q[i], scale if wide else 1.0),
                        lambda i, wide=get("wide"): integers(raw_x[i], scale if wide else 1.0),
                    )
        if state is not None:
            yield result()

    found = met.mapInArrow(meet, "block bigint, dim int, q_wide boolean, pos bigint, query_id bigint, vec_id bigint, score bigint, key binary")
    best = Window.partitionBy("block", "dim", "q_wide", "pos").orderBy(F.desc("score"), F.desc("key"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
