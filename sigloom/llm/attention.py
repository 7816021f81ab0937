"""A small causal self-attention language model over subword ids, in graphs of onnxruntime.

A subword's probability is that of its class given the context times that of the subword within
its class. Classes are a fixed partition of the vocabulary (word beginnings and continuations, by
rank); attention predicts the class, and the share within the class comes from counts over all
training texts, which the caller gathers.

One layer: x = E[class] + H[hashed subword] + P[place in window]; causal softmax attention over x;
o = tanh((x + z) W + b); class logits o U + c. Windows hold 32 places and advance by 16: each
subword is the target of exactly one window, with 16 to 31 subwords before it as context (a
document's first window begins with padding). No place is projected to a key or a value: the
products of the weights go to the side of the queries, which are half as many.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import accumulate

import numpy as np

from .common import spans
from .graph import Graph

WINDOW, STEP, DIM, HASHED = 32, 16, 16, 1024
BINS = 24  # per kind of subword
CLASSES = 2 * BINS + 1  # and the end
PAD = CLASSES  # a class of the input only


def classes_of(tokens: list[bytes], end_id: int) -> np.ndarray:
    """The class of each id; ``len(tokens)`` entries, and one more for padding."""
    out = np.zeros(len(tokens) + 1, dtype=np.int64)
    for kind in (True, False):
        own = np.array([i for i, t in enumerate(tokens) if i != end_id and t.startswith(b" ") is kind], dtype=np.int64)
        edges = np.unique(np.round(6 * (np.maximum(len(own), 7) / 6) ** np.linspace(0, 1, BINS)).astype(np.int64))
        out[own] = (0 if kind else BINS) + np.minimum(np.searchsorted(edges, np.arange(len(own)), side="right"), BINS - 1)
    out[end_id] = CLASSES - 1
    out[-1] = PAD
    return out


SHAPES = {
    "E": (CLASSES + 1, DIM),
    "H": (HASHED, DIM),
    "P": (WINDOW, DIM),
    "Q": (DIM, DIM),
    "K": (DIM, DIM),
    "V": (DIM, DIM),
    "W": (DIM, DIM),
    "b": (DIM,),
    "U": (DIM, CLASSES),
    "c": (CLASSES,),
}
SIZE = sum(map(math.prod, SHAPES.values()))
_FAR = np.where(np.arange(WINDOW)[None, :] <= (np.arange(STEP) + STEP - 1)[:, None], 0, -1e9).astype(np.float32)  # queries at 15..30


def initial(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    out = {}
    for name, shape in SHAPES.items():
        scale = {"E": 0.3, "H": 0.1, "P": 0.1, "b": 0.0, "c": 0.0}.get(name, shape[0] ** -0.5)
        out[name] = (scale * rng.standard_normal(shape)).astype(np.float32)
    return out


def pack(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[n].ravel() for n in SHAPES])


_PLACES = {n: slice(end - math.prod(s), end) for (n, s), end in zip(SHAPES.items(), accumulate(map(math.prod, SHAPES.values())))}


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    flat = np.asarray(flat, dtype=np.float32)
    return {n: flat[_PLACES[n]].reshape(shape) for n, shape in SHAPES.items()}


def hashed(ids: np.ndarray) -> np.ndarray:
    return (ids * np.int64(2654435761) >> np.int64(7)) % HASHED


def windows(ids: np.ndarray, sizes: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded ids in blocks of STEP, each window's first block, and each window's document, for documents in a row."""
    count = -(-sizes // STEP)
    base = np.cumsum(1 + count) - (1 + count)
    stream = np.full((int((1 + count).sum()), STEP), pad, dtype=ids.dtype)
    flat = stream.ravel()
    first = np.cumsum(sizes) - sizes
    for a, b in spans(sizes, 4096, 1 << 18):  # places of few ids at once
        own = slice(first[a], first[b - 1] + sizes[b - 1])
        flat[np.repeat((base[a:b] + 1) * STEP - first[a:b], sizes[a:b]) + np.arange(own.start, own.stop)] = ids[own]
    doc = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    return stream, base[doc] + nth, doc


def _pairs(blocks: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Windows of the blocks that begin at ``first``: whole blocks are copied, not places."""
    return np.take(blocks, first[:, None] + np.arange(WINDOW // STEP), axis=0).reshape(-1, WINDOW, *blocks.shape[2:])


def _rows(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of ``table``; each of 16 single-precision numbers is one line of the cache, as long as the first begins one."""
    size = at.size * DIM * table.itemsize
    raw = np.empty(size + 64, dtype=np.uint8)
    begin = -raw.ctypes.data % 64
    out = raw[begin : begin + size].view(table.dtype).reshape(*at.shape, DIM)
    return np.take(table, at, axis=0, out=out, mode="clip")  # other modes go by way of a copy


@lru_cache(maxsize=2)
def _gradient(dtype: np.dtype):
    """The number of targets times the gradient, in the order of SHAPES, and each target's probability.

    Scores are x Q K' x' and values a x V: with M = Q K' no place needs its own key or value.
    """
    g = Graph()
    value = lambda x: g.constant(np.array(x, dtype=dtype))
    whole = lambda *x: g.constant(np.array(x, dtype=np.int64))
    turn = lambda x: g("Transpose", x, perm=[0, 2, 1])
    column, rows, batch = whole(-1, 1), whole(-1, DIM), whole(-1, STEP, DIM)
    w = {n: g.input(n, dtype, *s) for n, s in SHAPES.items() if n not in "EHP"}
    X, row = g.input("X", dtype, "n", WINDOW, DIM), g.input("row", dtype, 1, "m")
    x_class, x_hash = g.input("x_class", np.int64, "n", WINDOW), g.input("x_hash", np.int64, "n", WINDOW)
    own, minus = g.input("own", np.int64, "m"), g.input("minus", dtype, "m")
    dead, none = g.input("dead", np.int64, "k", 1), g.input("none", dtype, "k", CLASSES)

    Xt, X3 = turn(X), g("Slice", X, whole(STEP - 1), whole(WINDOW - 1), whole(1))
    Xq = g("Reshape", X3, rows)
    M = g("Mul", g("Gemm", w["Q"], w["K"], transB=1), value(DIM**-0.5))
    q = g("Reshape", g("MatMul", Xq, M), batch)
    a = g("Softmax", g("Add", g("MatMul", q, Xt), value(_FAR)), axis=-1)
    y = g("Reshape", g("MatMul", a, X), rows)
    r = g("Gemm", y, w["V"], Xq)
    o = g("Tanh", g("Gemm", r, w["W"], w["b"]))
    p = g("Softmax", g("Gemm", o, w["U"], w["c"]), axis=-1)
    flat = g("Reshape", p, whole(-1))
    hit = g("Gather", flat, own)
    d = g("Reshape", g("ScatterND", flat, g("Reshape", own, column), minus, reduction="add"), whole(-1, CLASSES))
    d = g("ScatterND", d, dead, none)  # targets that don't count

    dU, dc = g("Gemm", o, d, transA=1), g("MatMul", row, d)
    do = g("Mul", g("Gemm", d, w["U"], transB=1), g("Sub", value(1), g("Mul", o, o)))
    dW, db = g("Gemm", r, do, transA=1), g("MatMul", row, do)
    dr = g("Gemm", do, w["W"], transB=1)
    dy = g("Gemm", dr, w["V"], transB=1)
    dV, dy_y = g("Gemm", y, dr, transA=1), g("Mul", dy, y)  # its sums over a row are taken from all products of the row
    dy = g("Reshape", dy, batch)
    da = g("Gemm", dy_y, value(np.full((DIM, WINDOW), -1)), g("Reshape", g("MatMul", dy, Xt), whole(-1, WINDOW)))
    ds = g("Mul", a, g("Reshape", da, whole(-1, STEP, WINDOW)))
    dq = g("Reshape", g("MatMul", ds, X), rows)
    dM = g("Mul", g("Gemm", Xq, dq, transA=1), value(DIM**-0.5))
    dX3 = g("Reshape", g("Gemm", dq, M, dr, transB=1), batch)
    dX = g("Add", g("MatMul", turn(a), dy), g("MatMul", turn(ds), q))
    dX = g("Add", dX, g("Pad", dX3, whole(0, STEP - 1, 0, 0, 1, 0)))
    at = lambda name, x: g("ScatterND", value(np.zeros(SHAPES[name])), g("Reshape", x, column), g("Reshape", dX, rows), reduction="add")
    out = {
        "E": at("E", x_class),
        "H": at("H", x_hash),
        "P": g("ReduceSum", dX, whole(0), keepdims=0),
        "Q": g("MatMul", dM, w["K"]),
        "K": g("Gemm", dM, w["Q"], transA=1),
        "V": dV,
        "W": dW,
        "b": g("Reshape", db, whole(-1)),
        "U": dU,
        "c": g("Reshape", dc, whole(-1)),
    }
    g.output(hit, dtype, "m")
    for name, shape in SHAPES.items():
        g.output(out[name], dtype, *shape)
    return g.session()


def loss_and_gradient(w, x_class, x_hash, target, live):
    """Mean cross-entropy of classes and its gradient for a batch of windows."""
    dtype = w["E"].dtype
    X = _rows(w["E"], x_class)
    X += _rows(w["H"], x_hash)
    X += w["P"]
    there = live.ravel()
    dead = np.flatnonzero(~there)
    given = {
        "X": X,
        "row": np.ones((1, target.size), dtype=dtype),
        "dead": dead.reshape(-1, 1),
        "none": np.zeros((len(dead), CLASSES), dtype=dtype),
        "x_class": x_class,
        "x_hash": x_hash,
        "own": target.ravel() + np.arange(0, target.size * CLASSES, CLASSES),
        "minus": np.full(target.size, -1, dtype=dtype),
    }
    hit, *parts = _gradient(dtype).run(None, given | {n: w[n] for n in SHAPES if n not in "EHP"})
    total = max(1, int(there.sum()))
    loss = -np.log(np.maximum(hit[there], 1e-30)).sum() / total
    return loss, {n: x * dtype.type(1 / total) for n, x in zip(SHAPES, parts)}


def train(w, ids, sizes, class_of, steps: int, batch: int = 384, rate: float = 0.02, seed: int = 1):
    """Adam over the windows of ``ids`` (documents in a row), in a seeded order.

    Every window is drawn once at least; fewer than ``steps`` batches are gone through again.
    """
    if not len(ids):
        return w
    pad = len(class_of) - 1
    stream, starts, _ = windows(ids, sizes, pad)
    rng = np.random.default_rng(seed)
    flat = pack(w)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    hash_of = hashed(np.arange(len(class_of)))
    order = rng.permutation(len(starts))
    steps = max(steps, -(-len(starts) // batch))
    for step in range(1, steps + 1):
        pick = np.take(order, np.arange((step - 1) * batch, step * batch), mode="wrap")
        tokens = _pairs(stream, starts[pick])
        x_class = np.take(class_of, tokens)
        target = x_class[:, STEP:]
        live = target != PAD
        _, g = loss_and_gradient(unpack(flat), x_class, np.take(hash_of, tokens), np.where(live, target, 0), live)
        now = rate * min(1.0, 2 * (1 - (step - 1) / steps))
        g = pack(g)
        first += np.float32(0.1) * (g - first)
        second += np.float32(0.02) * (g * g - second)
        flat -= np.float32(now / (1 - 0.9**step)) * first / (np.sqrt(second * np.float32(1 / (1 - 0.98**step))) + np.float32(1e-8))
    return unpack(flat)


@lru_cache(maxsize=2)
def _log_probability(small: bool):
    """Of each target's class, in single precision; ``small``: no logit is so large that its exponential leaves the range."""
    g = Graph()
    f32 = np.float32
    whole = lambda *x: g.constant(np.array(x, dtype=np.int64))
    X, own = g.input("X", f32, "n", WINDOW, DIM), g.input("own", np.int64, "m")
    M, VW, W, b, U, c = (g.input(n, f32, *s) for n, s in (("M", (DIM, DIM)), ("VW", (DIM, DIM)), *((n, SHAPES[n]) for n in "WbUc")))
    rows = whole(-1, DIM)
    Xq = g("Reshape", g("Slice", X, whole(STEP - 1), whole(WINDOW - 1), whole(1)), rows)
    s = g("MatMul", g("Reshape", g("MatMul", Xq, M), whole(-1, STEP, DIM)), g("Transpose", X, perm=[0, 2, 1]))
    a = g("Softmax", g("Add", s, g.constant(_FAR)), axis=-1)
    o = g("Tanh", g("Gemm", g("Reshape", g("MatMul", a, X), rows), VW, g("Gemm", Xq, W, b)))
    logit = g("Gemm", o, U, c)
    if small:
        total = g("Log", g("Reshape", g("MatMul", g("Exp", logit), g.constant(np.ones((CLASSES, 1), dtype=f32))), whole(-1)))
        g.output(g("Sub", g("Gather", g("Reshape", logit, whole(-1)), own), total), f32, "m")
    else:
        g.output(g("Gather", g("Reshape", g("LogSoftmax", logit, axis=-1), whole(-1)), own), f32, "m")
    return g.session()


class Scorer:
    """Scoring with fixed weights."""

    def __init__(self, w: dict[str, np.ndarray], class_of: np.ndarray, within: np.ndarray):
        """within: natural log of each id's share of its class."""
        self.class_of, self.within = class_of, within.astype(np.float32)
        self.x = w["E"][class_of] + w["H"][hashed(np.arange(len(class_of)))]
        self.P = w["P"]
        self.small = bool((np.abs(w["U"]).sum(axis=0) + np.abs(w["c"])).max() < 40)  # each |o| is below 1
        self.given = {"M": w["Q"] @ w["K"].T * np.float32(DIM**-0.5), "VW": w["V"] @ w["W"], **{n: w[n] for n in "WbUc"}}

    def __call__(self, ids: np.ndarray, sizes: np.ndarray, batch: int = 384) -> np.ndarray:
        """Natural-log probability of each document; batches are small enough to stay in the cache."""
        out = np.zeros(len(sizes))
        if not len(ids):
            return out
        pad = len(self.class_of) - 1
        stream, starts, doc = windows(ids, sizes, pad)
        per_window = np.zeros(len(starts))
        session = _log_probability(self.small)
        for a in range(0, len(starts), batch):
            first = starts[a : a + batch]
            X = _rows(self.x, _pairs(stream, first))
            X += self.P
            target = np.take(stream, first + 1, axis=0).ravel()
            cls = np.take(self.class_of, target)
            live = cls != PAD
            own = np.where(live, cls, 0) + np.arange(0, len(cls) * CLASSES, CLASSES)
            (found,) = session.run(None, {"X": X, "own": own, **self.given})
            value = np.where(live, found + np.take(self.within, target), 0.0)
            per_window[a : a + batch] = value.reshape(-1, STEP).sum(axis=1, dtype=np.float64)
        np.add.at(out, doc, per_window)
        return out
