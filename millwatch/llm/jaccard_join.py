"""Joining documents by the Jaccard similarity of their word shingles, light and heavy sets apart."""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millwatch.llm.common import table
from millwatch.llm.components import components
from millwatch.plans.storage import written
from millwatch.session import ship

#: Sets up to this size may be light, whatever the cost; bounds the histogram that settles the boundary.
LIGHT_LIMIT = 32
#: Share of sets of a class that may have so many empty blocks that these have to be keys too.
EMPTY_SHARE = 1e-6
#: Bits of the filter that tells from which documents sets are wanted: 2 MB, whatever the input.
FILTER_BITS = 24
#: Sets that one block of a key's list holds; blocks are compared in one task.
BLOCK = 2048
#: Bits of a parity sketch: a power of two near the set's size, between these. It only rules pairs out, at any width.
SKETCH_BITS = (512, 1 << 14)
#: Ids that two sets may share, far more than chance gives.
MAX_CLASHES = 1000
#: Copies of a component's smallest id, so that a hot component meets it in many tasks.
SALTS = 16

_ONE, _BASE = np.uint64(1), np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of ``width`` words of each text, A-Z lowered.

    A text with fewer words gives its whole sequence as one, one without words none.
    """
    raw = b"\x20".join((t or "").encode("utf-8", "surrogatepass") for t in texts) + b"\x20"
    lengths = np.fromiter((len((t or "").encode("utf-8", "surrogatepass")) + 1 for t in texts), "int64", len(texts))
    data = np.frombuffer(raw, "uint8")
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype("uint64")
    white = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.r_[True, white].astype("int8"))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return [np.zeros(0, "uint64")] * len(texts)
    # Hash of a word: its bytes as digits of a number in an odd base, from sums that run over all texts.
    powers = np.cumprod(np.r_[_ONE, np.full(len(data), _BASE)])
    sums = np.r_[np.uint64(0), np.cumsum((data + _ONE) * powers[:-1])]
    back = np.cumprod(np.r_[_ONE, np.full(len(data), _INVERSE)])
    word = _mix((sums[end] - sums[start]) * back[start] + (end - start).astype("uint64"))
    doc = np.searchsorted(np.cumsum(lengths), start, "right")
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    many = max(len(word) - width + 1, 0)
    window = np.zeros(many, "uint64")
    for k in range(width):
        window = _mix(window * np.uint64(3) + word[k:k + many] + _ONE)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            out.append(np.unique(window[a:b - width + 1]))
        else:
            whole = np.full(min(b - a, 1), b - a, "uint64")
            for at in range(a, b):
                whole = _mix(whole * np.uint64(5) + word[at])
            out.append(whole)
    return out


@dataclass(frozen=True)
class Scheme:
    """How sets become keys: two sets that are linked share a key.

    Sets are linked when ``100 * intersection >= percent * union``. Sizes fall into classes, the
    largest of a class being the smallest over the threshold; the sizes of linked sets lie in one
    class or in neighbours, so each set has keys for its own class and the next.

    Heavy pairs (the larger set above ``light``): the shingles are dealt by hash into ``blocks`` blocks.
    Linked sets differ in at most ``spare`` shingles, so at least ``blocks - spare`` blocks are equal;
    the contents of a block are a key, and the lists of sets under these keys are scanned. Empty
    blocks say nothing and are no keys, but where ``blocks - spare`` or more blocks are empty, these
    are keys too: each by itself in classes where that is rare, else (in small ones) each choice of so many.

    Light pairs: of linked sets the larger of which has ``b`` shingles, both contain a common subset
    of ``ceil(b * percent / 100)`` shingles; all subsets of that size are keys.
    """

    percent: int
    light: int = 0

    def partners(self, n: int) -> int:
        return n * 100 // self.percent

    def classes(self, n: int) -> tuple[int, int]:
        """Smallest size of the class of ``n`` and of the next."""
        low = 1
        while self.partners(low) < n:
            low = self.partners(low) + 1
        return low, self.partners(low) + 1

    def blocks(self, low: int) -> tuple[int, int, bool]:
        """Blocks for the class that begins at ``low``, shingles in which linked sets may differ, and whether too many empty ones are rare."""
        top = self.partners(low)
        spare = (100 - self.percent) * 2 * top // (100 + self.percent)
        smallest = -(-low * self.percent // 100)

        def tail(more: int) -> float:
            mean = (spare + more) * math.exp(-smallest / (spare + more))
            below = sum(math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) for k in range(more)) if mean > 0 else 1.0
            return max(1.0 - below, 0.0)

        # In large sets the empty blocks grow with the size, so do the blocks to spare for them.
        more = next((m for m in range(1, max(13, spare + 1)) if tail(m) < EMPTY_SHARE), 0)
        return (spare + more, spare, True) if more else (spare + min(range(1, 13), key=tail), spare, False)

    def light_keys(self, n: int) -> int:
        return sum(math.comb(n, -(-b * self.percent // 100)) for b in range(n, min(self.partners(n), self.light) + 1))

    def heavy_keys(self, n: int) -> int:
        return sum(self.blocks(low)[0] for low in self.classes(n)) if n > self.light or self.partners(n) > self.light else 0


def choose_scheme(percent: int, sizes: dict[int, int]) -> Scheme:
    """The boundary between light and heavy sets that makes the fewest keys for the given sizes (up to ``LIGHT_LIMIT``)."""
    def cost(light: int) -> int:
        scheme = Scheme(percent, light)
        return sum(count * (scheme.heavy_keys(n) + (scheme.light_keys(n) if n <= light else 0)) for n, count in sizes.items() if n)

    return Scheme(percent, min(range(LIGHT_LIMIT + 1), key=lambda x: (cost(x), x)))


class Keys:
    """Keys of sets under a scheme, with what is the same for all sets of a class kept."""

    def __init__(self, scheme: Scheme):
        self.scheme, self.known = scheme, {}

    def _class(self, n: int) -> list[tuple[int, int, int, bool]]:
        lows = self.scheme.classes(n)
        for low in lows:
            if low not in self.known:
                self.known[low] = (low, *self.scheme.blocks(low))
        return [self.known[low] for low in lows]

    def of(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of a set, and which of them are of its own class; keys of the next class only meet larger sets there."""
        n, scheme, out, own = len(items), self.scheme, [], []

        def add(keys: np.ndarray, is_own: bool) -> None:
            out.append(keys)
            own.append(np.full(len(keys), is_own))

        if not n:
            return items, np.zeros(0, bool)
        spread = _mix(items + np.uint64(0x632BE59BD9B4E019))
        if n <= scheme.light:
            total = spread.sum(keepdims=True)
            for b in range(n, min(scheme.partners(n), scheme.light) + 1):
                drop = n - -(-b * scheme.percent // 100)
                sums = total - np.array([spread[list(c)].sum() for c in itertools.combinations(range(n), drop)], "uint64")
                add(_mix(sums + _mix(np.array([b], "uint64"))), b == n)
        if n > scheme.light or scheme.partners(n) > scheme.light:
            for at_class, (low, blocks, spare, rare) in enumerate(self._class(n)):
                block = ((spread >> np.uint64(11)) % np.uint64(blocks)).astype("int64")
                order = np.argsort(block, kind="stable")
                at = np.flatnonzero(np.r_[True, np.diff(block[order]) > 0])
                full = block[order][at]
                tag = _mix(np.array([low], "uint64") + _BASE)
                add(_mix(_mix(np.add.reduceat(spread[order], at) + tag) + full.astype("uint64") * _BASE), at_class == 0)
                need, empty = blocks - spare, np.setdiff1d(np.arange(blocks), full)
                if len(empty) >= need:
                    marks = _mix(empty.astype("uint64") + tag)
                    add(_mix(np.array([marks[list(c)].sum() for c in itertools.combinations(range(len(empty)), 1 if rare else need)], "uint64") + np.uint64(7)), at_class == 0)
        keys, is_own = np.concatenate(out), np.concatenate(own)
        order = np.lexsort((~is_own, keys))
        keys, is_own = keys[order], is_own[order]
        first = np.r_[True, keys[1:] != keys[:-1]]
        return keys[first], is_own[first]


def sketch(items: np.ndarray) -> np.ndarray:
    """Bytes of the parities of a set's hashes by position. Each bit in which two sketches differ is a shingle that only one set has."""
    bits = min(max(1 << max(len(items) - 1, 0).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    at = ((_mix(items + np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(17)) % np.uint64(bits)).astype("int64")
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype("uint8"))


def _folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches of any widths as rows of words of the narrowest: a wider one is folded by exclusive or."""
    width = min(map(len, sketches))
    rows = np.empty((len(sketches), width), "uint8")
    for i, raw in enumerate(sketches):
        rows[i] = np.bitwise_xor.reduce(np.frombuffer(raw, "uint8").reshape(-1, width), axis=0)
    return rows.view("uint64")


def _sets(docs: DataFrame, width: int, emit, schema: str, renamed: frozenset[int] = frozenset(), wanted: bytes | None = None) -> DataFrame:
    """Run ``emit`` over the sets of all texts; it gives columns for a list of (doc_id, id, check, items).

    The id of a set is half of its digest, for ids in ``renamed`` the other half. ``wanted`` is a filter
    of documents (see ``_filter``): texts that it rules out are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for whole in batches:
            if wanted is not None:
                spot = whole.column("spot").to_numpy()
                whole = whole.filter(pa.array((np.frombuffer(wanted, "uint8")[spot >> 3] >> (spot & 7) & 1).astype(bool)))
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                rows = []
                for doc_id, items in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text").to_pylist(), width)):
                    digest = hashlib.blake2b(items.tobytes(), digest_size=16).digest()
                    first, second = (int.from_bytes(digest[half:half + 8], "little", signed=True) for half in (0, 8))
                    rows.append((doc_id, second if first in renamed else first, second, items))
                yield emit(rows, state)

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _spot(F.col("doc_id")).alias("spot")).mapInArrow(run, schema)


def _spot(doc_id: Column) -> Column:
    """Place of a document in the filter."""
    return F.shiftrightunsigned(F.xxhash64(doc_id.cast("long")), 64 - FILTER_BITS)


def _filter(doc_ids: DataFrame) -> bytes:
    """A bit for each hash prefix of the given doc_ids: of fixed size, so that it only spares work and never decides."""
    bits = np.zeros(1 << (FILTER_BITS - 3), "uint8")
    # One row for each of at most 2**FILTER_BITS / 32 words.
    masks = doc_ids.select(_spot(F.col("doc_id")).alias("spot")).groupBy(F.expr("spot div 32").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(spot % 32 as int)))").alias("mask"))
    for at, mask in masks.toPandas().itertuples(index=False):
        bits[at * 4:at * 4 + 4] = np.frombuffer(np.uint32(mask).tobytes(), "uint8")
    return bits.tobytes()


def _figures(docs: DataFrame, width: int) -> tuple[DataFrame, frozenset[int]]:
    """doc_id, n_shingles, id and sketch of every set, and the ids to rename.

    An id has 64 bits. Where two different sets share one, a handful among tens of billions of sets, both are
    named by the other half of their digests; should that clash again, it is an error.
    """
    def emit(rows, _):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[3]) for r in rows], pa.int64()),
                                           pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                                           pa.array([sketch(r[3]).tobytes() for r in rows], pa.binary())],
                                          names=["doc_id", "n_shingles", "id", "check", "sketch"])

    def clashes(df: DataFrame) -> list:
        return df.groupBy("id").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low < high").limit(MAX_CLASHES + 1).collect()

    figures = written(_sets(docs, width, emit, "doc_id long, n_shingles long, id long, check long, sketch binary"), "jaccard-docs")
    renamed = frozenset(r["id"] for r in clashes(figures))
    if renamed:
        figures = figures.withColumn("id", F.when(F.col("id").isin([*renamed]), F.col("check")).otherwise(F.col("id")))
        if len(renamed) > MAX_CLASHES or clashes(figures):
            raise ArithmeticError("two sets share an id")
    return figures, renamed


def _postings(docs: DataFrame, width: int, scheme: Scheme, renamed: frozenset[int]) -> DataFrame:
    """Keys and set ids, of keys that two different sets share, one of them in its own class: one shuffle of all keys, sorted, most of them dropped there."""
    def emit(rows, state):
        keys, seen = state.setdefault("keys", Keys(scheme)), state.setdefault("seen", set())
        fresh = [(r[1], r[3]) for r in rows if r[1] not in seen and not seen.add(r[1])]
        found = [keys.of(items) for _, items in fresh]
        flat = np.concatenate([k.view("int64") for k, _ in found]) if found else np.zeros(0, "int64")
        own = np.concatenate([o for _, o in found]) if found else np.zeros(0, bool)
        ids = np.repeat(np.array([i for i, _ in fresh], "int64"), [len(k) for k, _ in found])
        return pa.RecordBatch.from_arrays([pa.array(flat), pa.array(ids), pa.array(own)], names=["key", "id", "own"])

    postings = _sets(docs, width, emit, "key long, id long, own boolean", renamed)
    order = W.partitionBy("key").orderBy(F.desc("own"), "id")
    other = lambda c: c.isNotNull() & (c != F.col("id"))
    shared = (postings.withColumn("before", F.lag("id").over(order)).withColumn("after", F.lead("id").over(order)).withColumn("met", F.first("own").over(order))
              .where(F.col("met") & (other(F.col("before")) | other(F.col("after")))).select("key", "id").distinct())
    return written(shared, "jaccard-postings")


def _linked(pairs: DataFrame, docs: DataFrame, figures: DataFrame, width: int, percent: int, renamed: frozenset[int]) -> DataFrame:
    """Those of the pairs (a, b) whose sets reach the threshold, counted exactly. Only the sets of these pairs are made, from one document each."""
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "jaccard-ids")
    places = _filter(figures.join(ids, "id", "left_semi").groupBy("id").agg(F.min("doc_id").alias("doc_id")))

    def emit(rows, state):
        seen = state.setdefault("seen", set())
        kept = [r for r in rows if r[1] not in seen and not seen.add(r[1])]
        return pa.RecordBatch.from_arrays([pa.array([r[1] for r in kept], pa.int64()), pa.array([r[3].view("int64") for r in kept], pa.list_(pa.int64()))], names=["id", "items"])

    found = _sets(docs, width, emit, "id long, items array<long>", renamed, places)
    items = written(found.join(ids, "id", "left_semi").dropDuplicates(["id"]), "jaccard-sets")
    left, right = items.select(F.col("id").alias("a"), F.col("items").alias("x")), items.select(F.col("id").alias("b"), F.col("items").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (pairs.join(left, "a").join(right, "b").withColumn("common", common)
            .where(F.col("common") * 100 >= (F.size("x") + F.size("y") - F.col("common")) * percent).select("a", "b"))


def _chains(postings: DataFrame) -> DataFrame:
    """Under each key, neighbours in orders that put alike sets side by side: as many pairs as postings, not their square.

    A key of more than ``BLOCK`` sets is cut into slices by their marks, so that sets with equal marks stay neighbours.
    """
    marks = postings.groupBy("id").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    slices = postings.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("slices"))
    marked = postings.join(marks, "id").join(slices, "key")

    def neighbours(by: str) -> DataFrame:
        dealt = marked.withColumn("slice", F.pmod(F.xxhash64(by), F.col("slices")))
        return dealt.select(F.lag("id").over(W.partitionBy("key", "slice").orderBy(by, "id")).alias("a"), F.col("id").alias("b"))

    pairs = neighbours("low").unionByName(neighbours("high")).where("a is not null")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and sketches do not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = np.array([np.bitwise_count(np.bitwise_xor(*_folded([x, y]))).sum(dtype="int64") for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())], "int64")
            total = batch.column("m").to_numpy() + batch.column("n").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(far * (100 + percent) <= (100 - percent) * total))

    side = lambda id_, size, sketch_: sketches.select(F.col("id").alias(id_), F.col("size").alias(size), F.col("sketch").alias(sketch_))
    sized = (pairs.join(side("a", "m", "x").drop("x"), "a").join(side("b", "n", "y").drop("y"), "b")
             .where(F.least("m", "n") * 100 >= F.greatest("m", "n") * percent))
    ship(pairs.sparkSession)
    return (sized.join(side("a", "m", "x").drop("m"), "a").join(side("b", "n", "y").drop("n"), "b").select("a", "b", "m", "n", "x", "y")
            .mapInArrow(run, "a long, b long"))


def _compare(group: dict[str, np.ndarray | list], percent: int, whole: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs of one block of askers and one of others that the sketches do not rule out, and whether pairs were left for later.

    Unless ``whole``, more pairs than sets are cut to the most alike pair of each two components.
    """
    asks = group["asks"]
    if asks.all() or not asks.any():
        return np.zeros(0, "int64"), np.zeros(0, "int64"), False
    words = _folded(group["sketch"])
    ids, roots, sizes = group["id"], group["root"], group["size"]
    x, y = np.flatnonzero(asks), np.flatnonzero(~asks)
    told = group["outside"][y]
    found = []
    step = max(1, (1 << 20) // (len(y) * words.shape[1]))
    for at in range(0, len(x), step):
        part = x[at:at + step, None]
        apart = (roots[part] != roots[y]) & (~told | (ids[part] < ids[y]))
        total = sizes[part] + sizes[y]
        near = np.minimum(sizes[part], sizes[y]) * 100 >= np.maximum(sizes[part], sizes[y]) * percent
        differ = np.bitwise_count(words[part] ^ words[y]).sum(axis=2, dtype="int64")
        i, j = np.nonzero(apart & near & (differ * (100 + percent) <= (100 - percent) * total))
        found.append((part[i, 0], y[j], differ[i, j] / total[i, j]))
    i, j, far = (np.concatenate(c) for c in zip(*found))
    cut = not whole and len(i) > len(ids)
    if cut:
        low, high = np.minimum(roots[i], roots[j]), np.maximum(roots[i], roots[j])
        order = np.lexsort((far, high, low))
        best = order[np.r_[True, (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)]]
        cut = len(best) < len(i)
        i, j = i[best], j[best]
    return np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), cut


def _crossings(postings: DataFrame, roots: DataFrame, sketches: DataFrame, percent: int, whole: bool) -> DataFrame:
    """Pairs (a, b) under one key that are not yet connected and that sizes and sketches allow to be linked; ``cut`` where more are left.

    Of the sets under a key only those outside its most frequent component look for others, so a
    large group that is connected already costs nothing. Askers and others are dealt into blocks
    and compared inside tasks; a row is made for each set of a block, not for each pair.
    """
    told = postings.join(roots, postings.id == roots.node, "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    counts = told.groupBy("key", "root").agg(F.count("*").alias("n"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    main = (counts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("n"), F.count("*").alias("roots"))
            .where("roots > 1").select("key", "main", blocks(F.col("n") - F.col("most")).alias("ask_blocks"), blocks(F.col("n")).alias("all_blocks")))
    told = told.join(main, "key").withColumn("outside", F.col("root") != F.col("main"))
    at = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asks = told.where("outside").select("key", "id", "root", "outside", at(F.col("ask_blocks")).alias("i"), upto("all_blocks").alias("j"), F.lit(True).alias("asks"))
    rest = told.select("key", "id", "root", "outside", at(F.col("all_blocks")).alias("j"), upto("ask_blocks").alias("i"), F.lit(False).alias("asks"))
    met = asks.unionByName(rest).join(sketches, "id")
    names = ["id", "root", "size", "outside", "asks"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
            columns = {c: rows.column(c).to_numpy() for c in names}
            raw = rows.column("sketch").to_pylist()
            out = [_compare({c: v[a:b] for c, v in columns.items()} | {"sketch": raw[a:b]}, percent, whole) for a, b in zip(starts[:-1], starts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out])) for k in (0, 1)] + [pa.array(np.repeat([o[2] for o in out], [len(o[0]) for o in out]))], names=["a", "b", "cut"])

        held = None  # rows of a block that may go on in the next batch
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if not held.num_rows:
                continue
            group = [held.column(c).to_numpy() for c in ("key", "i", "j")]
            starts = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in group], axis=0)])
            if len(starts) > 1:
                yield pairs(held.slice(0, starts[-1]), starts)
                held = held.slice(starts[-1])
        if held is not None and held.num_rows:
            yield pairs(held, np.array([0, held.num_rows]))

    ship(postings.sparkSession)
    dealt = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").select("key", "i", "j", *names, "sketch")
    return dealt.mapInArrow(run, "a long, b long, cut boolean").groupBy("a", "b").agg(F.max("cut").alias("cut"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every document: the smallest doc_id that links lead to.

    Two documents are linked when their sets of word shingles overlap by ``percent`` of their union;
    a set without shingles is linked with nothing. Equal sets are one set from the start. Candidates
    come from ``Scheme``; all are checked on the whole sets, but for those that sketches prove apart.
    They are taken in goes: chains of neighbours first, then the pairs that are not connected by then
    (of many between two components the most alike, and in a last go the others, where they still are
    apart), so that a group of near copies needs far fewer checks than it has pairs, yet no link that
    matters is missed.

    Null and empty texts have no shingles. A document without id is linked like others but names no
    component; one of such only has a null component_id. Rows that repeat an id belong
    to it together as far as the smallest id goes, but are rows of their own. Only doc_id and text are
    read. No rows, no output.
    """
    figures, renamed = _figures(docs, width)
    sizes = figures.where(f"n_shingles between 1 and {LIGHT_LIMIT}").select("id", F.col("n_shingles").alias("size")).distinct()
    histogram = {r["size"]: r["n"] for r in sizes.groupBy("size").agg(F.count("*").alias("n")).collect()}
    scheme = choose_scheme(percent, histogram)
    postings = _postings(docs, width, scheme, renamed)
    sketches = (figures.join(postings.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])
                .select("id", F.col("n_shingles").alias("size"), "sketch"))
    sketches = written(sketches, "jaccard-sketches")

    def linked(pairs: DataFrame) -> DataFrame:
        return written(_linked(pairs, docs, figures, width, percent, renamed), "jaccard-links")

    tried = written(_possible(_chains(postings), sketches, percent), "jaccard-pairs")
    roots = components(linked(tried))
    for whole in (False, True):
        crossings = written(_crossings(postings, roots, sketches, percent, whole), "jaccard-pairs")
        rest = written(crossings.join(tried, ["a", "b"], "left_anti").select("a", "b"), "jaccard-pairs")
        more = linked(rest)
        if not more.isEmpty():
            roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
        # Asked of all crossings: the one pair left of a cut block may have been tried, its others were not.
        if crossings.where("cut").isEmpty():
            break
        tried = tried.unionByName(rest)
    return _with_components(figures, roots)


def _with_components(figures: DataFrame, roots: DataFrame) -> DataFrame:
    # A document alone in its component needs no look-up: only groups are joined back, in copies.
    told = figures.join(roots, figures.id == roots.node, "left").withColumn("group", F.when(F.col("n_shingles") > 0, F.coalesce("root", "id")))
    told = written(told.select("doc_id", "n_shingles", "group"), "jaccard-groups")
    groups = (told.where("`group` is not null").groupBy("group").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).where("n > 1")
              .select("group", "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = told.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return salted.join(groups, ["group", "salt"], "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def op2_jaccard(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 90)


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = d.doc_id
"""
