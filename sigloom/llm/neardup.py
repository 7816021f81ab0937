"""Near duplicates by BagMinHash, banding and verification.

A text's bag holds the bigrams of its words (lower-cased, ASCII punctuation as white space; a text
of one word has that word), each as often as it occurs. Steps:

1. One map computes each text's 64-bit id (JVM), its signature's band hashes, two bits of each
   component of the signature (the sketch). Within a task, equal texts are sketched once. The
   result is written once; the texts aren't shuffled.
2. Texts of one band hash are a bucket, its leader is the smallest id. Each text is taken together
   with the leader that its sketch agrees with most, if that makes the threshold likely. This gives
   preliminary classes; each of these links is verified later.
3. Within each bucket what is of different classes is compared; pairs inside a class aren't looked
   at, so a group of many different copies costs rows in proportion to its size, not to its square.
   In buckets of FEW texts, pairs whose sketches agree less than the threshold's by DEVIATIONS
   standard deviations are dropped within the join, and never written. Larger buckets meet block by
   block, all bags of a block at once.
4. Every link is verified: the multiset Jaccard overlap of the bags (32-bit hashes of the n-th
   occurrence of each bigram, made for the texts that need them) must reach ``threshold``. Where
   a link of step 2 fails, step 3 is repeated within its class from the verified links alone. So every pair of a
   bucket is compared, or ruled out by its sketches, or inside one class already.
5. Classes are the connected components of the verified links (alternating large-star and
   small-star steps on written tables). Copies (equal texts) share an id, hence a class, at no cost;
   they are never expanded into pairs.
6. n_links counts, class by class and in blocks of bounded size, all partners that reach the
   threshold; a link that no band caught is counted too. Only counts leave a block.

Result: doc_id, class_id (the smallest doc_id of the class), n_links (different texts of the class
whose overlap with it reaches the threshold), n_copies (rows with this very text, itself included).
Every row gets one result row, repeated rows too. Null counts as the empty text; texts without
words are in a class with their exact copies only. Long texts are one bag like any other; ties
(classes by the smallest doc_id, a null one after all others) are settled by the smallest id of a
text. Further columns aren't read, whatever their names, and ``keep_one`` returns them as they are.
An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bagminhash import U64, mix, signatures
from .common import discard, few_rows, pieces, strings, written

THRESHOLD, BANDS, ROWS = 0.5, 50, 4
#: Texts of a bucket up to which its pairs are taken one by one; bytes of bags that one block of a larger one, or of a class, holds.
FEW, BLOCK_BYTES = 64, 4 << 20
#: Ids (8 bytes each) that are broadcast at most; more are joined by a shuffle.
MOST_IDS = 4_000_000
#: Standard deviations of the agreeing components of a sketch (3 in 100,000 lie beyond).
DEVIATIONS = 4.0
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def bags_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Bag, element and weight of every distinct bigram, and each text's sorted occurrence hashes."""
    words = [t.encode("utf-8", "surrogatepass").translate(_PLAIN).split() for t in texts]
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    total = int(size.sum())
    h = mix(np.fromiter(map(crc32, chain.from_iterable(words)), dtype=U64, count=total) + U64(1))
    owner = np.repeat(np.arange(len(words)), size)
    pair = mix(h * U64(0x9E3779B97F4A7C15) + np.append(h[1:], U64(0))) if total else h
    if total:
        last = np.cumsum(size)[size > 0] - 1
        keep = np.ones(total, dtype=bool)
        keep[last] = size[size > 0] == 1  # a text's last word begins no bigram, unless it is the only one
        pair = np.where(size[owner] == 1, h, pair)[keep]
        owner = owner[keep]
    shift = U64(max(1, len(texts).bit_length()))
    key = np.sort(owner.astype(U64) << (U64(64) - shift) | pair >> shift)
    new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, dtype=bool)
    start = np.flatnonzero(new)
    weight = np.diff(np.append(start, len(key)))
    element = (key[start] << shift) >> U64(20)  # bits that any batch keeps alike
    bag = (key[start] >> (U64(64) - shift)).astype(np.int64)
    nth = np.arange(len(key)) - np.repeat(start, weight)
    occurrence = (mix(np.repeat(element, weight) + (nth.astype(U64) << U64(44))) >> U64(32)).astype(np.uint32)
    per_text = np.bincount((key >> (U64(64) - shift)).astype(np.int64), minlength=len(texts))
    return bag, element, weight, [np.sort(x) for x in np.split(occurrence, np.cumsum(per_text)[:-1])]


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    value = np.ascontiguousarray(signature).view(U64).reshape(len(signature), bands, rows)
    out = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U64)), value.shape[:2]).copy()
    for r in range(rows):
        out = mix(out ^ value[:, :, r] + U64(r + 1))
    return out.view(np.int64)


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of occurrence hashes."""
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return both / (len(a) + len(b) - both)


def sketch(docs: DataFrame, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    planes = 2 * (bands * rows // 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in pieces(batches, 512, text=2, limit=3 << 19):
            ids, texts = batch.column(1).to_pylist(), strings(batch.column(2))
            new = [i for i, t in enumerate(ids) if not (t in seen or seen.add(t))]
            band = [None] * len(ids)
            bits = np.zeros((planes, len(ids)), dtype=np.int64)
            if new:
                owner, element, weight, bags = bags_of([texts[i] for i in new])
                signature = signatures(owner, element, weight, len(new), bands * rows)
                bits[:, new] = planes_of(signature, planes // 2)
                for i, hashes, own in zip(new, band_hashes(signature, bands, rows), bags):
                    if len(own):
                        band[i] = hashes
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(band, pa.list_(pa.int64())), *map(pa.array, bits)],
                names=["doc_id", "id", "bands", *(f"p{i}" for i in range(planes))],
            )

    return _keyed(docs, id_col, text_col).mapInArrow(
        run, ", ".join(["doc_id bigint, id bigint, bands array<bigint>", *(f"p{i} bigint" for i in range(planes))])
    )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("id"), text.alias("text"))


def bags_for(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, bag) of the texts whose ids are in ``wanted``: made anew from the texts, as most texts need none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in pieces(batches, 512, text=1, limit=3 << 19):
            ids, texts = batch.column(0).to_pylist(), strings(batch.column(1))
            new = [i for i, t in enumerate(ids) if not (t in seen or seen.add(t))]
            if new:
                bags = bags_of([texts[i] for i in new])[3]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in new], pa.int64()), pa.array([b.astype("<u4").tobytes() for b in bags], pa.binary())], names=["id", "bag"]
                )

    texts = _keyed(docs, id_col, text_col).join(few_rows(wanted, MOST_IDS), "id", "left_semi").select("id", "text")
    return texts.mapInArrow(run, "id bigint, bag binary").groupBy("id").agg(F.any_value("bag").alias("bag"))


def planes_of(signature: np.ndarray, words: int) -> np.ndarray:
    """Two bits of each of the first 64 * words components, as 2 * words rows of 64-bit integers."""
    h = mix(np.ascontiguousarray(signature[:, : 64 * words]).view(U64)).reshape(len(signature), words, 64)
    place = U64(1) << np.arange(64, dtype=U64)
    bits = [((h >> U64(s) & U64(1)) * place).sum(axis=2, dtype=U64) for s in (0, 1)]
    return np.concatenate(bits, axis=1).T.astype(U64).view(np.int64)


def _agreeing(planes: int) -> str:
    """SQL for the number of components whose two bits agree in rows ``x`` and ``y``."""
    half = planes // 2
    return " + ".join(f"bit_count(~((x.p{i} ^ y.p{i}) | (x.p{half + i} ^ y.p{half + i})))" for i in range(half)) or "0"


def _limits(threshold: float, planes: int) -> tuple[int, int]:
    """Agreeing components below which a pair is out, and those that the threshold gives on average."""
    n, p = 32 * planes, threshold + (1 - threshold) / 4
    return math.floor(n * p - DEVIATIONS * math.sqrt(n * p * (1 - p))), math.ceil(n * p)


def _mixed(rows: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (with ``root``) of the buckets that hold several classes: of those of FEW texts at most, and of the others."""
    rooted = rows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = rooted.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("n")).where("x < y")
    return rooted.join(mixed.where(f"n <= {FEW}").select("band"), "band"), rooted.join(mixed.where(f"n > {FEW}").select("band"), "band")


def _cross(few: DataFrame, least: int, planes: int) -> DataFrame:
    """(a, b): the pairs of small buckets whose roots differ and whose sketches agree in ``least`` places.

    The condition is part of the join: what fails it is never written.
    """
    test = f"x.band = y.band and x.id < y.id and x.root <> y.root and {_agreeing(planes)} >= {least}"
    return few.alias("x").join(few.alias("y"), F.expr(test)).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def _joined(many: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that join what large buckets hold of different classes, each verified.

    A bucket is dealt to blocks of bounded size: a large class has blocks of its own, whose texts
    don't meet each other; smaller classes share blocks. Every two blocks that aren't of one class
    meet in a group of their own, where all bags are compared. A group gives a spanning forest of
    its links, never all of them.
    """
    bags = bags.join(few_rows(many.select("id").distinct(), MOST_IDS), "id", "left_semi")  # before they move
    own = many.join(bags, "id")
    per_class = own.groupBy("band", "root").agg(F.sum(F.length("bag")).alias("size"))
    rest = per_class.where(f"size <= {BLOCK_BYTES}").groupBy("band").agg(F.ceil(F.sum("size") / BLOCK_BYTES).alias("rest"))
    large = per_class.where(f"size > {BLOCK_BYTES}").select("band", "root", F.ceil(F.col("size") / BLOCK_BYTES).alias("parts"))
    dealt = own.join(large, ["band", "root"], "left").join(rest, "band", "left")
    block = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("root"), F.col("rest"))).otherwise(F.xxhash64("root", F.pmod(F.xxhash64("id"), F.col("parts"))))
    dealt = dealt.select("band", "id", "root", "bag", block.alias("block"), F.when(F.col("parts").isNotNull(), F.col("root")).alias("pure"))
    blocks = dealt.groupBy("band", "block").agg(F.first("pure").alias("pure"))
    meets = blocks.alias("x").join(blocks.alias("y"), F.expr("x.band = y.band and x.block <= y.block and coalesce(x.pure <> y.pure, true)"))
    meets = meets.select("x.band", F.col("x.block").alias("lo"), F.col("y.block").alias("hi"))
    sides = meets.withColumn("block", F.col("lo")).union(meets.where("lo < hi").withColumn("block", F.col("hi")))
    met = dealt.join(sides, ["band", "block"]).select("band", "lo", "hi", "block", "id", "root", "bag")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, (root, name) = table["id"].to_numpy(), (lambda r: (r[1], r[0]))(np.unique(table["root"].to_numpy(), return_inverse=True))
        first = table["block"].to_numpy() == table["lo"][0].as_py()
        bag = [np.frombuffer(x, dtype="<u4") for x in table["bag"].to_pylist()]
        one, two = np.flatnonzero(first), np.flatnonzero(~first)
        reach = _reach([bag[i] for i in one], [bag[i] for i in two] if len(two) else None, threshold)
        two = two if len(two) else one
        reach &= root[one][:, None] != root[two][None, :]
        parent = np.arange(len(name))

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        out = []
        for i, j in zip(*np.nonzero(reach)):
            x, y = find(root[one[i]]), find(root[two[j]])
            if x != y:
                parent[x] = y
                out.append((ids[one[i]], ids[two[j]]))
        found = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": found.min(axis=1), "b": found.max(axis=1)})

    return met.groupBy("band", "lo", "hi").applyInArrow(run, "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """The pairs with ``hit``: whether their bags' overlap reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            hit = [
                overlap(np.frombuffer(x, dtype="<u4"), np.frombuffer(y, dtype="<u4")) >= threshold
                for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(hit, pa.bool_())], names=["a", "b", "sure", "hit"])

    one = bags.select(F.col("id").alias("a"), F.col("bag").alias("bag_a"))
    two = bags.select(F.col("id").alias("b"), F.col("bag").alias("bag_b"))
    return (
        pairs.join(one, "a").join(two, "b").select("a", "b", "sure", "bag_a", "bag_b").mapInArrow(run, "a bigint, b bigint, sure boolean, hit boolean")
    )


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in (a, b) but the roots: root is the smallest id of its component.

    Rounds of large-star and small-star steps until every edge ends at a root.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not edges.select("v").join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty() or not edges.groupBy("u").count().where("count > 1").isEmpty():
        before = edges
        # large star: each node's larger neighbours are linked to its smallest one
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        edges = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: each node and its smaller neighbours are linked to the smallest of them
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        star = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = written(star.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(before)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _reach(one: list[np.ndarray], two: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which bags of ``one`` (rows) reach the threshold with which of ``two``, or of ``one``, but themselves, if None."""
    bags = one + (two or [])
    n, cut = len(bags), len(one)
    size = np.fromiter(map(len, bags), dtype=np.int64, count=n)
    element, at = np.unique(np.concatenate(bags), return_inverse=True)
    often = np.bincount(at, minlength=len(element))
    owner = np.repeat(np.arange(n), size)
    rows, cols = (slice(0, cut), slice(cut, n)) if two else (slice(0, n), slice(0, n))
    both = np.zeros((rows.stop - rows.start, cols.stop - cols.start), dtype=np.float32)
    # Elements of several bags only; so many columns at once that the table stays at 32 MB.
    new = np.full(len(element), -1, dtype=np.int64)
    shared = np.flatnonzero(often > 1)
    new[shared] = np.arange(len(shared))
    column, own = new[at], owner
    column, own = column[column >= 0], own[column >= 0]
    order = np.argsort(column, kind="stable")
    column, own = column[order], own[order]
    width = max(1, (8 << 20) // n)
    for a in range(0, len(shared), width):
        lo, hi = np.searchsorted(column, (a, a + width))
        table = np.zeros((n, min(width, len(shared) - a)), dtype=np.float32)
        table[own[lo:hi], column[lo:hi] - a] = 1
        both += table[rows] @ table[cols].T
    reach = both >= threshold * (size[rows, None] + size[None, cols] - both) * (1 - 1e-6)
    if two is None:
        np.fill_diagonal(reach, False)
    return reach


def degrees(members: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """(id, n_links): the other texts of its class that a text reaches the threshold with.

    Classes of two have the one link that made them. The bags of a larger class meet in one group,
    or, beyond BLOCK_BYTES, in blocks, every two of which meet in a group of their own. Only counts
    leave a group, never its pairs.
    """
    size = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    pairs = members.join(size.where("n = 2"), "root").select("id", F.lit(1).cast("bigint").alias("n_links"))
    own = members.join(size.where("n > 2").select("root"), "root").join(bags, "id")
    blocks = own.groupBy("root").agg(F.ceil(F.sum(F.length("bag")) / BLOCK_BYTES).alias("blocks"))
    dealt = own.join(blocks, "root").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = dealt.select("root", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "id", "bag")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        bag = [np.frombuffer(x, dtype="<u4") for x in table["bag"].to_pylist()]
        first = table["own"].to_numpy() == lo
        ids = table["id"].to_numpy()
        if lo == hi:
            n = _reach(bag, None, threshold).sum(axis=1)
        else:
            one, two = [b for b, f in zip(bag, first) if f], [b for b, f in zip(bag, first) if not f]
            ids = np.concatenate((ids[first], ids[~first]))
            reach = _reach(one, two, threshold) if one and two else np.zeros((len(one), len(two)))
            n = np.concatenate((reach.sum(axis=1), reach.sum(axis=0)))
        return pa.table({"id": ids, "n_links": n.astype(np.int64)})

    found = dealt.groupBy("root", "lo", "hi").applyInArrow(run, "id bigint, n_links bigint")
    return pairs.union(found.groupBy("id").agg(F.sum("n_links").alias("n_links")))


def _search(docs: DataFrame, threshold: float, bands: int, rows: int, id_col: str, text_col: str):
    """(id, doc_id) of every row, (id, root) of the linked texts but the roots, bags of all candidates."""
    planes = 2 * (bands * rows // 64)
    p = [f"p{i}" for i in range(planes)]
    least, likely = _limits(threshold, planes)
    sketches = written(sketch(docs, bands, rows, id_col, text_col), "sketches")
    ids = written(sketches.select("id", "doc_id"), "ids")
    marks = written(sketches.where("bands is not null").groupBy("id").agg(*(F.any_value(x).alias(x) for x in p)), "marks")
    # Buckets of two texts or more, each with its leader, the smallest id; minima are taken before the exchange.
    members = sketches.where("bands is not null").select(F.explode("bands").alias("band"), "id")
    full = members.groupBy("band").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader < last").select("band", "leader")
    shared = written(members.join(full, "band"), "buckets")
    # Each text and the leader that it agrees with most: preliminary classes, assumed until they are verified.
    led = shared.where("id <> leader").select("id", "leader").distinct()
    led = led.join(marks.alias("x"), "id").join(marks.withColumnRenamed("id", "leader").alias("y"), "leader")
    led = led.select("id", "leader", F.expr(_agreeing(planes)).alias("n")).where(f"n >= {likely}")
    assumed = written(led.groupBy("id").agg(F.max_by("leader", F.struct("n", "leader")).alias("a")).select("a", F.col("id").alias("b")), "assumed")
    roots = components(assumed)
    buckets = written(shared.select("band", "id").distinct().join(marks, "id"), "buckets")
    discard(shared, marks)
    few, many = _mixed(buckets, roots)
    pairs = assumed.withColumn("sure", F.lit(True)).union(_cross(few, least, planes).withColumn("sure", F.lit(False)))
    pairs = written(pairs.groupBy("a", "b").agg(F.max("sure").alias("sure")), "pairs")
    many = written(many.select("band", "id", "root"), "large")
    # Whoever is left out here for being in a class already is one of ``assumed``: no bag beyond these is ever asked for.
    wanted = written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(many.select("id")).distinct(), "wanted")
    bags = written(bags_for(docs, wanted, id_col, text_col), "bags")
    discard(sketches)
    verified = written(_verified(pairs, bags, threshold), "verified")
    hits = verified.where("hit").select("a", "b")
    links = hits.union(written(_joined(many, bags, threshold), "joined"))
    failed = verified.where("sure and not hit").select(F.col("b").alias("id"))
    before, roots = roots, components(links)
    if not failed.isEmpty():
        # Some assumptions failed: the preliminary classes that they held together are compared within, from the verified links.
        broken = failed.join(before, "id").select("root").distinct()
        inside = written(before.join(broken, "root").select("id").union(broken).distinct(), "inside")
        few, many = _mixed(buckets.join(few_rows(inside, MOST_IDS), "id", "left_semi"), roots)
        many = written(many.select("band", "id", "root"), "large")
        pairs = written(_cross(few, least, planes).withColumn("sure", F.lit(False)).join(verified.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        more = written(_verified(pairs, bags, threshold), "verified").where("hit").select("a", "b")
        links = links.union(more).union(written(_joined(many, bags, threshold), "joined"))
        roots = components(links)
    discard(buckets, assumed)
    return ids, roots, bags


def _texts(ids: DataFrame, roots: DataFrame) -> DataFrame:
    """id, n_copies, class_id of every different text."""
    texts = ids.groupBy("id").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_copies"))
    texts = texts.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    return texts.join(texts.groupBy("root").agg(F.min("first").alias("class_id")), "root").select("id", "class_id", "n_copies")


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, doc_id, class_id, n_links, n_copies of every row; ``id`` is the text's."""
    ids, roots, bags = _search(docs, threshold, bands, rows, id_col, text_col)
    members = written(roots.union(roots.select("root", "root").distinct()), "members")
    degree = written(degrees(members, bags, threshold), "degrees")
    discard(bags)
    texts = _texts(ids, roots).join(degree, "id", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("bigint")))
    return ids.join(texts, "id").select("id", "doc_id", "class_id", "n_links", "n_copies")


def keep_one(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of each class with all its columns: that of the smallest id.

    Rows without an id count as larger than all; of rows that agree in id and text one stays. The
    rows travel in a struct of their own, so that no name of theirs can clash with one in here.
    """
    ids, roots, bags = _search(docs, threshold, bands, rows, id_col, text_col)
    discard(bags)
    found = ids.join(_texts(ids, roots), "id")
    stay = found.where("doc_id <=> class_id").groupBy("id", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.first("class_id").alias("class_id"))
    # Two texts of a class may share its smallest id: the one with the smaller text id stays.
    stay = stay.groupBy("class_id", "doc_id", F.when(F.col("class_id").isNull(), F.col("id")).alias("lone")).agg(F.min_by("id", "id").alias("id"), F.max("n").alias("n"))
    stay = written(stay.select("id", "doc_id", "n"), "stay")
    text = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    keyed = docs.select(F.struct("*").alias("row"), text.alias("text"), F.col(f"`{id_col}`").cast("bigint").alias("doc"))
    kept = keyed.join(stay, (keyed["text"] == stay["id"]) & keyed["doc"].eqNullSafe(stay["doc_id"]), "left_semi")
    if not stay.where("n > 1").isEmpty():
        kept = kept.dropDuplicates(["doc", "text"])
    return kept.select("row.*")
