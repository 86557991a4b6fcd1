"""Line dedup by content-defined chunks of lines and by repeated runs of lines."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millwatch.llm.common import WORD, table
from millwatch.plans.storage import written
from millwatch.session import ship

#: The rolling hash spans so many lines; one in ``DIVISOR`` values ends a chunk.
SPAN, DIVISOR = 2, 2
#: A line of so many words is a chunk of its own.
LONG_WORDS = 50
#: Repeated chunks go if they have so many lines and words, or ``LONG_WORDS``: shorter ones may be alike by chance.
MIN_LINES, MIN_WORDS = 2, 10
#: Copies of what belongs to a repeated chunk, so that the documents of a hot one meet it in many tasks:
#: ``SALTS`` of its count, and of its text one for each ``PER_SALT`` repeats, up to ``MAX_SALTS``.
SALTS = 16
PER_SALT, MAX_SALTS = 500, 64

#: Hash of a run of lines: line hashes as digits of a number in ``BASE``, modulo a prime.
PRIME, BASE = (1 << 127) - 1, 0x1E3779B97F4A7C15F39CC0605CEDC835

_words = re.compile(WORD)


def chunks(text: str) -> list[tuple[int, int, int]]:
    """Cut the lines of a text: first and last+1 line and number of words of each chunk.

    A chunk ends where the rolling hash of the last ``SPAN`` line hashes says so, and before and
    after each long line. Boundaries depend on nearby lines only: an inserted line shifts none but
    those beside it.
    """
    lines = text.split("\n")
    out, since, words, roll = [], 0, 0, []
    for i, line in enumerate(lines):
        n = sum(1 for _ in _words.finditer(line))
        roll = [*roll[1 - SPAN:], zlib.crc32(line.encode("utf-8", "surrogatepass"))]
        mixed = 0
        for value in roll:
            mixed = (mixed * 2654435761 + value) & 0xFFFFFFFF
        if n >= LONG_WORDS:
            if since < i:
                out.append((since, i, words))
            out.append((i, i + 1, n))
            since, words, roll = i + 1, 0, []
            continue
        words += n
        if (mixed >> 7) % DIVISOR == 0:
            out.append((since, i + 1, words))
            since, words = i + 1, 0
    if since < len(lines):
        out.append((since, len(lines), words))
    return out


def chunk_spans(text: str) -> list[tuple[int, int]]:
    """First and last+1 line of the chunks that may be removed: of many lines, or of a long one."""
    return [(a, b) for a, b, n in chunks(text) if n >= LONG_WORDS or b - a >= MIN_LINES and n >= MIN_WORDS]


def run_spans(text: str) -> list[tuple[int, int]]:
    """The shortest runs of ``LONG_WORDS`` words from each line on, and up to each line.

    Each line of any longer run lies in one of those inside it: in that from the line on or, where
    this goes beyond the run, in that up to the run's end. So a repeated run is found by spans of
    equal content, whatever lines are around it.
    """
    sums = [0]
    for line in text.split("\n"):
        sums.append(sums[-1] + len(_words.findall(line)))
    out, end, start = set(), 0, 0
    for at in range(len(sums)):
        while end < len(sums) and sums[end] - sums[at] < LONG_WORDS:
            end += 1
        if end < len(sums):
            out.add((at, end))
        while sums[at] - sums[start + 1 if start < at else at] >= LONG_WORDS:
            start += 1
        if sums[at] - sums[start] >= LONG_WORDS:
            out.add((start, at))
    return sorted(out)


def all_spans(text: str) -> list[tuple[int, int]]:
    return sorted({*chunk_spans(text), *run_spans(text)})


def _hashes(text: str, spans: list[tuple[int, int]]) -> list[int]:
    """A number below 2**127 for each span of lines, in one pass over the lines however spans overlap."""
    lines = text.split("\n")
    sums, powers = [0], [1]
    for line in lines if spans else ():
        value = int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=15).digest(), "little") + 1
        sums.append((sums[-1] * BASE + value) % PRIME)
        powers.append(powers[-1] * BASE % PRIME)
    return [(sums[b] - sums[a] * powers[b - a]) % PRIME for a, b in spans]


def _merged(copies: list[dict]) -> list[tuple[int, int, str, int]]:
    """Spans that meet, and whose first occurrences meet alike, as one: start, end, key and start of the first."""
    out: list[list] = []
    for first_key, shift, start, end in sorted((c["first_key"], c["first_start"] - c["start"], c["start"], c["end"]) for c in copies):
        if out and out[-1][2:] == [first_key, shift] and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end, first_key, shift])
    return [(start, end, first_key, start + shift) for start, end, first_key, shift in out]


def _key() -> Column:
    """Identity of a document: its id and text. Rows alike in both count as one document."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.coalesce("text", F.lit(""))))


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def repeated_spans(docs: DataFrame, spans: Callable[[str], list[tuple[int, int]]]) -> DataFrame:
    """The spans of lines (key, start, end) of documents that equal, byte by byte, the first occurrence of their text.

    First is the smallest doc_id (null last), then key and place; what overlaps it does not count as
    a copy. Hashes are counted without texts; spans that lie beside each other in copy and first
    occurrence become one, and the texts of these only are then gathered and compared.
    """
    keyed = docs.select(_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = spans(text)
                rows += [(h >> 64, (h & 0xFFFFFFFFFFFFFFFF) - (1 << 63), key, doc_id, a, b) for (a, b), h in zip(own, _hashes(text, own))]
            yield _batch(rows, ["high", "low", "key", "doc_id", "start", "end"], [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32()])

    found = written(keyed.mapInArrow(hashes, "high long, low long, key string, doc_id long, start int, end int"), "line-spans")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key", "start")).alias("first")
    repeated = (found.groupBy("high", "low").agg(F.count("*").alias("n"), first).where("n > 1")
                .select("high", "low", F.col("first.key").alias("first_key"), F.col("first.start").alias("first_start"),
                        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    apart = (F.col("key") != F.col("first_key")) | (F.col("start") >= F.col("first_start") + F.col("end") - F.col("start"))
    copies = (found.drop("doc_id").withColumn("salt", F.pmod(F.xxhash64("key", "start"), F.lit(SALTS)).cast("int")).join(repeated, ["high", "low", "salt"]).where(apart)
              .groupBy("key").agg(F.collect_set(F.struct("start", "end", "first_key", "first_start")).alias("copies")))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(key, *m) for key, own in zip(*(c.to_pylist() for c in batch.columns)) for m in _merged(own)]
            yield _batch(rows, ["key", "start", "end", "first_key", "first_start"], [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32()])

    copies = written(copies.mapInArrow(merge, "key string, start int, end int, first_key string, first_start int"), "line-copies")
    # A document whose lines are copied often is held in as many places as keep the comparisons of each few.
    salts = F.least(F.ceil(F.count("*") / PER_SALT), F.lit(MAX_SALTS)).cast("int")
    firsts = copies.groupBy(F.col("first_key").alias("key")).agg(
        F.min("first_start").alias("start"), F.max(F.col("first_start") + F.col("end") - F.col("start")).alias("end"), salts.alias("salts"))
    place = F.xxhash64("key", "start")
    told = firsts.select(F.col("key").alias("first_key"), "salts", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("bucket"))
    salted = copies.withColumn("bucket", F.pmod(place, F.lit(SALTS)).cast("int")).join(told, ["first_key", "bucket"])
    salted = salted.withColumn("salt", F.pmod(F.shiftright(place, 8), F.col("salts")).cast("int")).drop("salts", "bucket")
    none = F.lit(None)
    wanted = salted.unionByName(firsts.select("key", "start", "end", none.cast("string").alias("first_key"), none.cast("int").alias("first_start"), F.col("salts").alias("salt")))
    wanted = wanted.groupBy("key").agg(F.collect_list(F.struct("start", "end", "first_key", "first_start", "salt")).alias("wanted"))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, want in zip(*(c.to_pylist() for c in batch.columns)):
                lines = text.split("\n")
                rows += [(key, w["start"], w["end"], w["first_key"], w["first_start"], w["salt"], "\n".join(lines[w["start"]:w["end"]])) for w in want]
            yield _batch(rows, ["key", "start", "end", "first_key", "first_start", "salt", "text"],
                         [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string()])

    shown = written(keyed.select("key", "text").join(wanted, "key")
                    .mapInArrow(texts, "key string, start int, end int, first_key string, first_start int, salt int, text string"), "line-texts")
    held = (shown.where("first_key is null").dropDuplicates(["key"])
            .select(F.col("key").alias("first_key"), F.col("start").alias("held_start"), F.col("end").alias("held_end"), F.col("text").alias("held"),
                    F.explode(F.sequence(F.lit(0), F.col("salt") - 1)).alias("salt")))
    n = F.col("end") - F.col("start")
    part = F.array_join(F.slice(F.split("held", "\n"), F.col("first_start") - F.col("held_start") + 1, n), "\n")
    same = F.when(n == F.col("held_end") - F.col("held_start"), F.col("held")).otherwise(part) == F.col("text")
    return shown.where("first_key is not null").join(held, ["first_key", "salt"]).where(same).select("key", "start", "end").distinct()


def dedup_lines(docs: DataFrame, spans: Callable[[str], list[tuple[int, int]]] = chunk_spans) -> DataFrame:
    """Documents with repeated chunks of lines removed from ``text``; ``lines_removed`` counts the lines.

    Text is cut into chunks of lines (see ``chunks``); a chunk of at least ``MIN_LINES`` lines and
    ``MIN_WORDS`` words, or of ``LONG_WORDS`` words, stays at its first occurrence (smallest doc_id, null last) and goes
    everywhere else, also later in the same document. Texts without such a chunk stay as they are.
    ``spans`` gives the lines that go together in place of chunks.

    A null text stays null, an empty one empty. Rows alike in doc_id and text count as one document:
    each keeps the same text. Other columns pass unchanged, whatever their names;
    ``lines_removed`` replaces a column of that name. No rows, no output.
    """
    ship(docs.sparkSession)
    columns = [c for c in docs.columns if c != "lines_removed"]
    removed = repeated_spans(docs, spans).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("gone"))
    rows = docs.select(_key().alias("key"), F.col("text"), F.struct(*(F.col(f"`{c}`") for c in columns if c != "text"), F.lit(1).alias("_one")).alias("row"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("text", T.StringType()), T.StructField("lines_removed", T.LongType())])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                n = 0
                if gone:
                    lines = text.split("\n")
                    drop = {i for g in gone for i in range(g["start"], g["end"])}
                    n = len(drop)
                    text = "\n".join(line for i, line in enumerate(lines) if i not in drop)
                texts.append(text)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=["row", "text", "lines_removed"])

    out = rows.join(removed, "key", "left").select("row", "text", "gone").mapInArrow(clean, schema)
    return out.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in columns), "lines_removed")


def dedup_passages(docs: DataFrame) -> DataFrame:
    """As ``dedup_lines``, and also without the lines of any run of ``LONG_WORDS`` words that is in an earlier place."""
    return dedup_lines(docs, all_spans)


def op6_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_passages(docs).select("doc_id", "lines_removed", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("lines_kept"),
                                    F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), "text")
