"""Removing byte strings that an earlier document has: bucket-pointer refinement of sampled suffixes.

Suffixes fall into buckets by their first ``GRAM`` bytes. A bucket of one document goes; the others
are refined by the bucket identifiers of later offsets: the identifier at depth 32 is made of those at
depth 16 of a suffix and of the suffix 16 further on, that at depth 50 of two of depth 32, and so on, so
each level reuses the one before and no level reads more bytes than the first.

Only sampled suffixes carry rows at the first level: of each window of the length asked for, that whose
gram has the smallest hash (its anchor). Equal windows have equal anchors at equal offsets, so a window can
only be a copy if its anchor's bucket has two documents. Around such an anchor all its windows lie in
one context; contexts that are alike count once, with their smallest document, and only different
contexts are refined further, down to single windows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millwatch.llm.common import table
from millwatch.llm.hashes import mix
from millwatch.plans.storage import discard, written
from millwatch.session import ship

#: Bytes of a first bucket, and the shortest string that the second level can part in two such sides.
GRAM = 16
SHORTEST = 3 * GRAM
#: Bytes of text that one round of arrays holds; a longer text is a round of its own.
ROUND = 1 << 18
#: Goes that single windows are refined in, by their anchor's bucket, which equal windows share: a part of the disk at a time.
GOES = 4
#: Entries that a task sorts at once before it sends them, and the bits of their keys that tell packs apart: as many packs for any cluster.
HELD = 1 << 20
PACK_BITS = 12

_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
#: Two identifiers of 64 bits each, by different constants: 128 bits decide, the first alone rules out.
_LANES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _pair(x: np.ndarray, y: np.ndarray, lane: int) -> np.ndarray:
    """Identifier of a bucket from those of its two parts."""
    return mix(mix(x + _LANES[lane]) * _ODD + y)


class Bytes:
    """Texts end to end, with the bucket identifiers of their suffixes."""

    def __init__(self, texts: list[bytes]):
        self.lengths = np.fromiter(map(len, texts), "int64", len(texts))
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.n = int(self.lengths.sum())
        self._raw = b"".join([*texts, bytes(GRAM)])
        self._words = np.ndarray((self.n + GRAM - 7,), "<u8", self._raw, strides=(1,))

    def grams(self, lane: int) -> np.ndarray:
        """Identifiers at depth ``GRAM`` of every suffix; those that reach beyond a text are not to be used."""
        return _pair(self._words[:self.n], self._words[8:self.n + 8], lane)

    def at(self, place: np.ndarray, depth: int, lane: int) -> np.ndarray:
        """Identifiers of the suffixes at some places, refined from ``GRAM`` to any greater depth."""
        if depth == GRAM:
            return _pair(self._words[place], self._words[place + 8], lane)
        half = 1 << (depth - 1).bit_length() - 1
        return _pair(self.at(place, half, lane), self.at(place + depth - half, half, lane), lane)

    def all_at(self, depth: int, lane: int) -> np.ndarray:
        """As ``at``, for the suffixes of all places that have so many bytes."""
        if depth == GRAM:
            return self.grams(lane)[:max(self.n - GRAM + 1, 0)]
        half = 1 << (depth - 1).bit_length() - 1
        ids = self.all_at(half, lane)
        return _pair(ids[:max(self.n - depth + 1, 0)], ids[depth - half:], lane)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of all windows of ``length`` bytes inside a text, the anchor of each, and all identifiers at depth ``GRAM``."""
        grams = self.grams(0)
        start = np.flatnonzero(np.arange(self.n) + length <= np.repeat(self.ends, self.lengths))
        best = (grams & _HIGH) | np.arange(self.n, dtype="uint64")
        width, span = length - GRAM + 1, 1
        while span < width:
            step = min(span, width - span)
            best = np.minimum(best[:-step], best[step:]) if len(best) > step else best[:0]
            span += step
        return start, (best[start] & _LOW).astype("int64"), grams


def _rounds(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, Bytes]]:
    """A batch in parts of about ``ROUND`` bytes."""
    texts = batch.column(column).to_pylist()
    since, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > ROUND:
            yield batch.slice(since, i - since), Bytes(texts[since:i])
            since, size = i, 0
        size += len(text)
    if since < len(texts):
        yield batch.slice(since), Bytes(texts[since:])


def _run(df: DataFrame, column: str, schema: str, emit: Callable[[pa.RecordBatch, Bytes], list[np.ndarray]]) -> DataFrame:
    """``emit`` over rounds of rows: it gives the columns of the output."""
    ship(df.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in _rounds(batch, column):
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in emit(part, text)], names=names)

    return df.mapInArrow(run, schema)


def _long(ids: np.ndarray) -> np.ndarray:
    return ids.view("int64")


def _anchors(text: Bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, text and bucket of each anchor."""
    _, place, grams = text.windows(length)
    place = place[np.flatnonzero(np.diff(place, prepend=-1))]
    return place, np.searchsorted(text.ends, place, "right"), grams[place]


def _shared(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Buckets that two documents have, with the smallest; counted on the map side, so a hot bucket is no group."""
    return written(rows.groupBy(*keys).agg(F.min("d").alias("least"), F.max("d").alias("most")).where("least < most").select(*keys, "least"), name)


def _grouped(keys: list[np.ndarray], d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that puts entries of equal keys together, and for each in that order the smallest and largest document of its keys."""
    order = np.argsort(keys[0])
    alike = np.diff(keys[0][order]) == 0
    for key in keys[1:]:
        if (np.diff(key[order])[alike] != 0).any():
            order = np.lexsort(keys[::-1])
            alike = np.logical_and.reduce([np.diff(k[order]) == 0 for k in keys])
    start = np.flatnonzero(np.r_[True, ~alike])
    sizes, d = np.diff(np.r_[start, len(d)]), d[order]
    return order, np.repeat(np.minimum.reduceat(d, start), sizes), np.repeat(np.maximum.reduceat(d, start), sizes)


def _blobs(columns: list[np.ndarray], bounds: np.ndarray) -> list[pa.Array]:
    """Columns of numbers as byte strings, cut at bounds."""
    return [pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * c.itemsize).astype("int32")), pa.py_buffer(np.ascontiguousarray(c))]) for c in columns]


def _met(df: DataFrame, column: str, kinds: dict[str, str], keys: int, out: list[str], later: bool, emit: Callable[[pa.RecordBatch, Bytes], list[np.ndarray]]) -> DataFrame:
    """Of entries, the columns ``out`` of those whose keys two documents have; with ``later``, not of those of the smallest document.

    ``emit`` gives the columns ``kinds`` (name: type) over rounds of rows: as many keys as told, "d" and others. Entries go in
    packs, one for each part of the first key, from which they are told apart by sorting. What is settled among the entries that a
    task holds goes along with any pack, and of each key only what is still open goes by the key, so a hot bucket is no group.
    """
    ship(df.sparkSession)
    names, at = list(kinds), list(kinds).index("d")
    bits, most_held = PACK_BITS, HELD
    edges = np.arange(1, 1 << bits, dtype="uint64") << np.uint64(64 - bits)
    sent, sure = [f"e{i}" for i in range(len(names))], [f"s{i}" for i in range(len(out))]

    def pack(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*held)]
        order, low, high = _grouped(columns[:keys], columns[at])
        columns = [c[order] for c in columns]
        d = columns[at]
        least, most = d == low, d == high
        fresh = np.r_[True, (d[1:] != d[:-1]) | (columns[0][1:] != columns[0][:-1])]  # without other columns, entries alike count once where they meet
        open_, settled = (least, ~least) if later else ((least | most) & fresh, ~(least | most) & fresh)
        open_, settled = np.flatnonzero(open_), np.flatnonzero(settled)
        by_key = np.r_[0, np.searchsorted(columns[0][open_], edges), len(open_)]
        even = np.arange((1 << bits) + 1) * len(settled) >> bits
        packed = pa.RecordBatch.from_arrays([pa.array(np.arange(1 << bits, dtype="int32")), *_blobs([c[open_] for c in columns], by_key),
                                             *_blobs([columns[names.index(n)][settled] for n in out], even)], names=["p", *sent, *sure])
        full = (np.diff(by_key) > 0) | (np.diff(even) > 0)
        return packed if full.all() else packed.filter(pa.array(full))

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part, text in _rounds(batch, column):
                held.append([np.ascontiguousarray(c, kinds[n]) if n == "d" else c.astype(kinds[n], copy=False) for n, c in zip(names, emit(part, text))])
                size += len(held[-1][0])
                if size >= most_held:
                    yield pack(held)
                    held, size = [], 0
        if size:
            yield pack(held)

    def told(packs: list[pa.RecordBatch]) -> list[np.ndarray]:
        columns = [np.frombuffer(b"".join(x for b in packs for x in b.column(e).to_pylist()), kinds[n]) for n, e in zip(names, sent)]
        rest = [np.frombuffer(b"".join(x for b in packs for x in b.column(e).to_pylist()), kinds[n]) for n, e in zip(out, sure)]
        if len(columns[0]):
            order, low, high = _grouped(columns[:keys], columns[at])
            keep = order[columns[at][order] > low] if later else order[low < high]
            rest = [np.concatenate([r, columns[names.index(n)][keep]]) for n, r in zip(out, rest)]
        return rest

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = [], None
        for batch in batches:
            p = batch.column("p").to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(p)) + 1, len(p)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if held and p[a] != part:
                    yield pa.RecordBatch.from_arrays([pa.array(c.view("int64") if c.dtype.kind == "u" else c) for c in told(held)], names=out)
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
                    part = p[a]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c.view("int64") if c.dtype.kind == "u" else c) for c in told(held)], names=out)

    dealt = df.mapInArrow(packs, ", ".join(["p int", *[f"{c} binary" for c in (*sent, *sure)]])).repartition("p").sortWithinPartitions("p")
    return dealt.mapInArrow(meet, ", ".join(f"{n} {'int' if kinds[n] == 'int32' else 'long'}" for n in out))


def _survivors(docs: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """(d, tag, buckets): of the first of equal texts, the buckets of its anchors that another such text has, too.

    Copies of whole texts need no part in it: what a document has, the first of its equals has.
    """
    def buckets(part: pa.RecordBatch, text: Bytes) -> list[np.ndarray]:
        _, own, bucket = _anchors(text, length)
        return [bucket, part.column("d").to_numpy()[own]]

    own = docs.join(firsts, ["d", "tag"], "left_semi").select("d", "text")
    met = _met(own, "text", {"bucket": "uint64", "d": "int64"}, 1, ["d", "bucket"], False, buckets)
    out = written(met.groupBy("d").agg(F.collect_list("bucket").alias("buckets")).join(firsts, "d"), "suffix-anchors")
    discard()
    return out


def _contexts(docs: DataFrame, survivors: DataFrame, length: int) -> DataFrame:
    """(c1, c2, d, tag, place): identifier of the context of each surviving anchor, the bytes of all windows that can have it.

    It is made of the first and last window, which cover the context, and of the anchor's place in it.
    """
    def emit(part: pa.RecordBatch, text: Bytes) -> list[np.ndarray]:
        place, own, bucket = _anchors(text, length)
        # A bucket that one of these documents shares is shared by all that have it.
        keep = np.flatnonzero(np.isin(bucket, part.column("buckets").flatten().to_numpy().view("uint64")))
        place, own = place[keep], own[keep]
        low, high = _around(text, place, own, length)
        shape = ((place - low) << 32 | (high - low)).astype("uint64")
        ids = [_pair(_pair(text.at(low, length, lane), text.at(high - length, length, lane), lane), shape, lane) for lane in (0, 1)]
        return [_long(ids[0]), _long(ids[1]), part.column("d").to_numpy()[own], part.column("tag").to_numpy()[own], (place - text.starts[own]).astype("int32")]

    told = docs.join(survivors, ["d", "tag"]).select("d", "tag", "buckets", "text")
    return written(_run(told, "text", "c1 long, c2 long, d long, tag long, place int", emit), "suffix-contexts")


def _around(text: Bytes, place: np.ndarray, own: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 byte of the contexts of anchors: as far as windows that hold them reach."""
    return np.maximum(place + GRAM - length, text.starts[own]), np.minimum(place + length, text.ends[own])


def _at_anchors(docs: DataFrame, kinds: DataFrame, columns: list[str], schema: str, emit: Callable[..., list]) -> DataFrame:
    """``emit`` over the texts of the kinds' smallest documents: it gets the rows, the texts, and of each anchor its row, place and columns."""
    def run(part: pa.RecordBatch, text: Bytes) -> list:
        found = part.column("anchors")
        own = np.repeat(np.arange(part.num_rows), found.value_lengths().to_numpy(zero_copy_only=False))
        anchors = found.flatten()
        return emit(text, own, anchors.field("place").to_numpy() + text.starts[own], part.column("d").to_numpy()[own], *(anchors.field(c).to_numpy() for c in columns))

    anchors = kinds.groupBy("d", "tag").agg(F.collect_list(F.struct("place", *columns)).alias("anchors"))
    return _run(docs.join(anchors, ["d", "tag"]).select("d", "anchors", "text"), "text", schema, run)


def _copied_windows(docs: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """(c1, c2, offsets): of each kind of context, the windows (bytes from their start to the anchor) that one of a smaller document has."""
    def sides(text: Bytes, own: np.ndarray, place: np.ndarray, d: np.ndarray, c: np.ndarray) -> list:
        """Depth 32 on both sides of the anchor: each window holds the anchor and ``GRAM`` bytes before or after it."""
        after, before = np.flatnonzero(place + 2 * GRAM <= text.ends[own]), np.flatnonzero(place - GRAM >= text.starts[own])
        ids = np.concatenate([text.at(place[after], 2 * GRAM, 0), _pair(text.at(place[before] - GRAM, 2 * GRAM, 0), np.zeros(1, "uint64"), 0)])
        rows = np.concatenate([after, before])
        return [_long(ids), d[rows], c[rows], np.repeat(np.array([1, 2], "int32"), [len(after), len(before)])]

    def contexts(text: Bytes, own: np.ndarray, place: np.ndarray, d: np.ndarray, c: np.ndarray, side: np.ndarray) -> list:
        """Bytes of the contexts with a side that was met, and the go that they belong to."""
        low, high = _around(text, place, own, length)
        found = pa.array([text._raw[a:b] for a, b in zip(low.tolist(), high.tolist())], pa.binary())
        return [c, d, (text.at(place, GRAM, 0) % np.uint64(GOES)).astype("int32"), (place - low).astype("int32"), side, found]

    def windows(part: pa.RecordBatch, text: Bytes) -> list[np.ndarray]:
        """Windows that have this anchor and whose side was met before, refined to their whole length."""
        start, place, _ = text.windows(length)
        own = np.searchsorted(text.ends, start, "right")
        anchor, side = (text.starts + part.column("left").to_numpy())[own], part.column("sides").to_numpy()[own]
        offset = place - start
        met = ((side & 1) > 0) & (offset <= length - 2 * GRAM) | ((side & 2) > 0) & (offset >= GRAM)
        keep = np.flatnonzero((place == anchor) & met)
        start, own, offset = start[keep], own[keep], offset[keep]
        return [*(text.at(start, length, lane) for lane in (0, 1)), part.column("d").to_numpy()[own], part.column("c").to_numpy()[own], offset]

    sided = written(_at_anchors(docs, kinds, ["c"], "side_id long, d long, c long, side int", sides), "suffix-sided")
    discard()
    shared = _shared(sided, ["side_id"], "suffix-sides")
    discard()
    met = sided.join(shared.select("side_id").hint("shuffle_hash"), "side_id", "left_semi").groupBy("c").agg(F.expr("bit_or(side)").alias("sides"))
    met = written(kinds.select("d", "tag", "c", "place").join(met, "c"), "suffix-met")
    discard(sided, shared)
    told = written(_at_anchors(docs, met, ["c", "sides"], "c long, d long, go int, left int, sides int, context binary", contexts), "suffix-bytes")
    discard(met)
    met = told
    parts = []
    for go in range(GOES):
        hits = _met(met.where(F.col("go") == go), "context", {"w1": "uint64", "w2": "uint64", "d": "int64", "c": "int64", "offset": "int32"}, 2, ["c", "offset"], True, windows)
        parts.append(written(hits.groupBy("c").agg(F.collect_set("offset").alias("offsets")), "suffix-offsets"))
        discard()
    discard(met)
    # Each kind is in one go only.
    out = written(kinds.select("c", "c1", "c2").join(functools.reduce(DataFrame.unionByName, parts), "c").drop("c"), "suffix-offsets")
    discard(*parts)
    return out


def _spans(docs: DataFrame, length: int) -> DataFrame:
    """(d, tag, found): what to remove of each document, as anchors with the offsets of their copied windows (null: all).

    Equal texts are one from the start: where a smaller document has the whole text, all of it is found at once.
    """
    twice = docs.select("d", "tag", F.xxhash64(F.lit(1), "text").alias("second"), F.octet_length("text").alias("n")).withColumnRenamed("tag", "first")
    texts = written(twice.groupBy("first", "second", "d").agg(F.max("n").alias("n")), "suffix-texts")
    least = texts.groupBy("first", "second").agg(F.min("d").alias("least"))
    told = texts.join(least, ["first", "second"]).withColumnRenamed("first", "tag")
    firsts = written(told.where("d = least").select("d", "tag").distinct(), "suffix-firsts")
    survivors = _survivors(docs, firsts, length)
    discard(firsts)
    contexts = _contexts(docs, survivors, length)
    discard(survivors)
    # Of one row each, as both follow the same comparisons; numbers alone are folded without a sort.
    one = contexts.groupBy("c1", "c2").agg(F.min("d").alias("d"), F.min_by("tag", "d").alias("tag"), F.min_by("place", "d").alias("place"))
    kinds = one.select("c1", "c2", "d", "tag", "place", F.monotonically_increasing_id().alias("c"))
    kinds = written(kinds, "suffix-kinds")  # numbered by what is written, whatever is computed again
    discard()
    copied = _copied_windows(docs, kinds, length)
    of_kind = kinds.select("c1", "c2", F.col("d").alias("least")).join(copied, ["c1", "c2"], "left")
    found = (contexts.join(of_kind, ["c1", "c2"]).where("d > least or offsets is not null")
             .select("d", "tag", F.struct("place", F.when(F.col("d") == F.col("least"), F.col("offsets")).alias("offsets")).alias("one")))
    again = F.array(F.struct(F.lit(None).cast("int").alias("place"), F.lit(None).cast("array<int>").alias("offsets")))
    whole = told.where(F.col("d") > F.col("least")).where(F.col("n") >= length).select("d", "tag", again.alias("found"))
    found = written(found.groupBy("d", "tag").agg(F.collect_list("one").alias("found")).unionByName(whole), "suffix-found")
    discard(texts, contexts, kinds, copied)
    return found


def _cut(texts: list[bytes], found: pa.ListArray, length: int) -> Iterator[tuple[list[dict], bytes]]:
    """Of each text, maximal removed runs (first and last+1 byte) and the other bytes."""
    counts = found.value_lengths().fill_null(0).to_numpy()
    ends, flat = np.cumsum(counts), found.flatten()
    place, offsets = flat.field("place"), flat.field("offsets")
    whole, everything = place.is_null().to_numpy(zero_copy_only=False), offsets.is_null().to_numpy(zero_copy_only=False)
    place, sizes = place.fill_null(0).to_numpy(), offsets.value_lengths().fill_null(0).to_numpy()
    upto, offsets = np.r_[0, np.cumsum(sizes)], offsets.flatten().to_numpy()
    for text, end, n in zip(texts, ends.tolist(), counts.tolist()):
        if not n:
            yield [], text
            continue
        own, gone = slice(end - n, end), np.zeros(len(text) + 1, "int64")
        gone[0] += whole[own].any()
        full = place[own][everything[own] & ~whole[own]]
        start = np.repeat(place[own], sizes[own]) - offsets[upto[end - n]:upto[end]]
        np.add.at(gone, np.r_[np.maximum(full + GRAM - length, 0), start], 1)
        np.add.at(gone, np.r_[np.minimum(full + length, len(text)), start + length], -1)
        out = np.cumsum(gone)[:-1] > 0
        edge = np.diff(np.r_[False, out, False].astype("int8"))
        spans = [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
        yield spans, np.frombuffer(text, "uint8")[~out].tobytes()


def remove_copied_bytes(docs: DataFrame, length: int = 50) -> DataFrame:
    """Documents with ``removed_spans`` (byte ranges of the text in UTF-8) and ``kept`` (the bytes outside them).

    Removed is every byte covered by a string of ``length`` bytes that also starts in a document with a
    smaller doc_id. Strings are those of the input, not of what is left; they never cross documents;
    overlapping ones count. ``length`` is ``SHORTEST`` at least.

    A null text counts as empty, and a text shorter than ``length`` loses nothing. A null doc_id counts as
    larger than any other; rows of one doc_id take nothing from each other, equal or not, and equal rows
    keep the same bytes. ``kept`` may begin or end inside a character. Other columns pass unchanged,
    whatever their names; only those called ``removed_spans`` or ``kept`` are replaced. No rows, no output.
    """
    if length < SHORTEST:
        raise ValueError(f"strings of at least {SHORTEST} bytes")
    ship(docs.sparkSession)
    own = [c for c in docs.columns if c not in ("removed_spans", "kept")]
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("d"), F.xxhash64(text, F.col("doc_id").isNull()).alias("tag"),
                        text.cast("binary").alias("text"), F.struct(*(F.col(f"`{c}`") for c in own if c != "text"), F.col("text").isNull().alias("_none")).alias("row"))
    found = _spans(keyed.select("d", "tag", "text"), length)
    schema = T.StructType([T.StructField("row", keyed.schema["row"].dataType), T.StructField("text", T.BinaryType()),
                           T.StructField("removed_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                           T.StructField("kept", T.BinaryType())])
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                out = list(_cut(batch.column("text").to_pylist(), batch.column("found"), length))
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), pa.array([o[0] for o in out], pairs), pa.array([o[1] for o in out], pa.binary())],
                                                 names=["row", "text", "removed_spans", "kept"])

    told = keyed.join(found, ["d", "tag"], "left").select("row", "text", "found").mapInArrow(cut, schema)
    return told.select(*(F.when(~F.col("row._none"), F.col("text").cast("string")).alias("text") if c == "text" else F.col("row")[c].alias(c) for c in own), "removed_spans", "kept")


def op12_suffix_dedup(spark, sf_dir):
    out = remove_copied_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return out.select("doc_id", n.alias("n_bytes"), (n - F.octet_length("kept")).alias("n_removed"), F.size("removed_spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = """
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
starts AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM raw)),
least_of AS (SELECT s, min(doc_id) AS m, max(doc_id) AS x FROM starts GROUP BY s HAVING m < x),
copied AS (SELECT doc_id, i, coalesce(i - lag(i) OVER w > 50, true)::INT AS new FROM starts JOIN least_of USING (s) WHERE doc_id > m WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM copied),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, run),
pieces AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM runs),
kept AS (
  SELECT p.doc_id, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || any_value(substr(h, 2 * last + 1)) AS k, sum(b - a) AS gone, count(*) AS spans
  FROM pieces p JOIN raw USING (doc_id) JOIN (SELECT doc_id, max(b) AS last FROM runs GROUP BY doc_id) USING (doc_id) GROUP BY p.doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM raw LEFT JOIN kept USING (doc_id)
"""
