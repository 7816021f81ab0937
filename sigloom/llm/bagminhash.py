"""BagMinHash signatures in numpy, for a batch of bags at once.

An element of weight w owns the interval [0, w). The axis is cut into dyadic intervals [0,1),
[1,2), [2,4), [4,8) ...; on each of them a Poisson process of rate ``m`` per unit, seeded by the
element, gives points in the order of their values, and every point falls on one of ``m``
components. A component's minimum over all points in the bag is a weighted MinHash: two bags share
it with the probability of their weighted Jaccard similarity.

The processes are refined hierarchically: the first point of a longer interval is handed to one of
its halves (a fair coin), the other half starts anew from that value, and halves beyond w are
dropped, down to intervals of one unit. Refinement doesn't depend on w, so equal elements of two
bags see equal points. A process ends once its next value exceeds the largest minimum of its bag,
so that most elements cost one or two points.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_GOLDEN = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _exp(state: np.ndarray) -> np.ndarray:
    """Standard exponential from a state."""
    return -np.log(((state >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53)


class _Bags:
    def __init__(self, count: int, m: int):
        self.m = m
        self.low = np.full(count * m, np.inf)
        self.most = np.full(count, np.inf)

    def emit(self, bag: np.ndarray, value: np.ndarray, state: np.ndarray) -> None:
        component = (mix(state ^ U64(0x5851F42D4C957F2D)) >> U64(32)) * U64(self.m) >> U64(32)
        np.minimum.at(self.low, bag * self.m + component.astype(np.int64), value)

    def settle(self, bags: np.ndarray) -> None:
        self.most[bags] = self.low.reshape(-1, self.m)[bags].max(axis=1)


def signatures(bag: np.ndarray, element: np.ndarray, weight: np.ndarray, count: int, m: int) -> np.ndarray:
    """``count`` x ``m`` doubles; rows of bags without elements are infinite.

    bag: each element's bag; element: 64-bit hashes; weight: positive integers.
    """
    bags = _Bags(count, m)
    bag = bag.astype(np.int64)
    level = np.zeros(len(weight), dtype=np.int64)
    at = np.arange(len(weight))
    owner, lo, size, seed = [bag], [np.zeros_like(bag)], [np.ones_like(bag)], [mix(element + _GOLDEN)]
    top = 1
    while True:  # [1,2), [2,4), [4,8) ... as far as the weight reaches
        at = at[weight[at] > top]
        if not len(at):
            break
        level[at] += 1
        owner.append(bag[at])
        lo.append(np.full(len(at), top, dtype=np.int64))
        size.append(np.full(len(at), top, dtype=np.int64))
        seed.append(mix(element[at] + U64(int(_GOLDEN) * (2 * top + 1) & (1 << 64) - 1)))
        top *= 2
    limit = [weight]
    for k in range(1, len(owner)):
        limit.append(weight[level >= k])
    owner, lo, size, seed, limit = map(np.concatenate, (owner, lo, size, seed, limit))
    value = _exp(seed) / (m * size)
    units = np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=U64), np.zeros(0, dtype=U64)
    first = True
    while len(owner) or len(units[0]):
        # Longer intervals hand their point down; those of one unit give it out.
        near = value <= bags.most[owner]
        owner, lo, size, seed, limit, value = (x[near] for x in (owner, lo, size, seed, limit, value))
        one = size == 1
        if one.any():
            bags.emit(owner[one], value[one], seed[one])
            units = tuple(map(np.concatenate, zip(units, (owner[one], value[one], seed[one], np.zeros(int(one.sum()), dtype=U64)))))
        owner, lo, size, seed, limit, value = (x[~one] for x in (owner, lo, size, seed, limit, value))
        if len(owner):
            half = size // 2
            right = (seed & U64(1)).astype(bool)
            heir, other = mix(seed ^ U64(0xD6E8FEB86659FD93)), mix(seed ^ U64(0xA0761D6478BD642F))
            heir_lo, other_lo = np.where(right, lo + half, lo), np.where(right, lo, lo + half)
            lo = np.concatenate((heir_lo, other_lo))
            value = np.concatenate((value, value + _exp(other) / (m * half)))
            seed, owner, size, limit = np.concatenate((heir, other)), np.tile(owner, 2), np.tile(half, 2), np.tile(limit, 2)
            inside = lo < limit
            owner, lo, size, seed, limit, value = (x[inside] for x in (owner, lo, size, seed, limit, value))
        b, v, s, j = units
        if not first:
            bags.settle(np.unique(b))
        first = False
        near = v <= bags.most[b]
        b, v, s, j = b[near], v[near], s[near], j[near]
        if len(b):
            steps = int(min(64, max(1, 16384 // len(b))))
            nth = j[:, None] + np.arange(1, steps + 1, dtype=U64)
            state = mix(s[:, None] + nth * _GOLDEN)
            run = np.empty((len(b), steps + 1))
            run[:, 0] = v
            run[:, 1:] = _exp(state) / m
            run = np.cumsum(run, axis=1)[:, 1:]  # one addition after the other, whatever the number of steps
            use = run <= bags.most[b][:, None]
            bags.emit(np.broadcast_to(b[:, None], run.shape)[use], run[use], state[use])
            v, j = run[:, -1], j + U64(steps)
        units = b, v, s, j
    return bags.low.reshape(count, m)
