"""Operators against SQL, the public libraries and plain versions, and on rows that have something odd."""

from __future__ import annotations

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from compare import differences, duck
from conftest import TINY
from pyspark.sql import functions as F

from millwatch.llm import jaccard_join, knn_join, licenses, line_dedup, mixing, pieces, quality, sharding, toxicity, warc
from millwatch.llm.queries import ORACLES, QUERIES
from millwatch.plans.storage import fresh_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, salt int, id long, key string, words int"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30000))


def docs(spark, rows=None):
    """Nulls, empty and very long texts, ties, repeated rows, columns with clashing names."""
    rows = rows if rows is not None else [
        (1, "a b c d e f", "en", "s1", 11), (1, "a b c d e f", "en", "s1", 11), (2, None, None, None, None), (3, "", "en", "s1", 0), (4, " \n\t ", "en", "s2", 3),
        (None, "a b c d e f", "en", "s2", 11), (5, LONG, "en", "s1", len(LONG)), (6, LONG, "en", None, len(LONG)), (7, "one two", "de", "s1", 7)]
    return spark.createDataFrame([(*r, "x", "y", 1, 2, "k", 3) for r in rows], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, TINY).toPandas(), duck(TINY).execute(ORACLES[name]).df()) == ""


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))


def test_empty_tables(spark):
    none = docs(spark, [])
    assert sharding.assign_shards(none).count() == mixing.mix(none).count() == quality.quality(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == jaccard_join.near_duplicates(none).count() == 0
    assert pieces.encode_decode(none, pieces.piece_model()).count() == 0
    assert licenses.scan(none.select(F.col("doc_id").alias("file_key"), F.lit("a/b").alias("path"), "text")).count() == 0
    assert knn_join.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id % 2 = 0").count() == 0
    folder = fresh_path(spark, "warc")
    index = warc.write(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read(index, folder).count() == 0
    model = toxicity.learn(none, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(none, model).count() == 0


def test_shards_of_odd_rows(spark):
    rows = sharding.assign_shards(docs(spark), 4).collect()
    assert len(rows) == 9
    sizes = [sum(r["shard"] == s for r in rows) for s in range(4)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] == 2} == {(8, 0)}
    assert all(r["text_crc32"] == zlib.crc32(b"one two") for r in rows if r["doc_id"] == 7)


def test_mix_of_odd_rows(spark):
    rows = mixing.mix(docs(spark)).collect()
    assert len(rows) == 9 and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["ord"], []).append(r)
    for group in by.values():
        assert sum(r["taken"] for r in group) == int(group[0]["target"] + 0.5) <= 3 * group[0]["source_size"]


def test_first_slots_are_those_of_the_schedule(spark):
    rows = spark.createDataFrame([(i, "w " * (37 * i % 900), "abc"[i % 3]) for i in range(200)], "doc_id long, text string, source string")
    found = mixing.mix(rows).collect()
    sources = mixing.source_targets(mixing.measured(rows, 11)).cache()
    size = {r["ord"]: r["source_size"] for r in sources.collect()}
    slots = sorted((r["slot"], r["ord"], r["block"], r["words"]) for r in mixing.schedule(sources).collect())
    for r in found:
        took = []
        for slot, ord_, block, words in slots:
            low, high = max(r["start"], block * mixing.BLOCK), min(r["start"] + r["size"], block * mixing.BLOCK + words)
            if ord_ == r["ord"] and low < high:
                took.append((slot, low - block * mixing.BLOCK, high - low))
        assert r["taken"] == sum(t[2] for t in took) and sum(size.values()) > 0
        assert (r["first_slot"], r["slot_offset"]) == (min(took)[:2] if took else (-1, -1))


def test_schedule_keeps_the_mixture_in_every_stretch(spark):
    rows = spark.createDataFrame([(i, "w " * 500, "abc"[i % 3]) for i in range(300)], "doc_id long, text string, source string")
    sources = mixing.source_targets(mixing.measured(rows, 1)).cache()
    slots = [r["ord"] for r in mixing.schedule(sources).orderBy("slot").collect()]
    share = {r["ord"]: r["slots"] for r in sources.collect()}
    assert {o: slots.count(o) for o in share} == share
    for cut in (len(slots) // 4, len(slots) // 2):
        assert all(abs(slots[:cut].count(o) - n * cut / len(slots)) < 6 for o, n in share.items())


def test_quality_of_odd_rows(spark):
    rows = {r["doc_id"]: r for r in quality.quality(docs(spark)).collect()}
    assert rows[2]["n_words"] == rows[3]["n_words"] == 0 and rows[2]["base_failed"] and not rows[2]["kept"]
    assert rows[5]["n_words"] == 30000 and rows[5]["n_repeat_words"] == 0


def test_host_with_many_failures_is_refused(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, good if i % 10 == 0 else "bad", None, "spam", 0) for i in range(200)] + [(i, good, None, f"ok{i % 8}", 0) for i in range(200, 600)]
    kept = {r["doc_id"] for r in quality.quality(docs(spark, rows)).where("kept").collect()}
    assert kept == set(range(200, 600))


def test_shingles_equal_plain_ones():
    def plain(text, n):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\v", " ").replace("\f", " ").split(" ")
        w = [x for y in w for x in y.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if x]
        return len({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())

    texts = [None, "", " \n", "One two", "a b c a b c a b c", "É é x y\tz\vq", LONG, "x"]
    for n in (3, 5):
        assert [len(s) for s in jaccard_join.shingle_sets(texts, n)] == [plain(t, n) for t in texts]
    a, b = jaccard_join.shingle_sets(["A b c", "a B C"], 3)
    assert (a == b).all()


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_key(percent):
    rng = np.random.default_rng(3)
    for light in (0, 12):
        keys = jaccard_join.Keys(jaccard_join.Scheme(percent, light))
        for n in [*range(1, 40), 60, 100, 333]:
            for _ in range(20):
                a = rng.integers(0, 2 ** 63, n).astype("uint64")
                spare = n * (100 - percent) // 100
                drop, add = int(rng.integers(0, spare + 1)), 0
                while 100 * (n - drop) >= percent * (n + add + 1):
                    add += 1
                add = int(rng.integers(0, add + 1))
                b = np.r_[a[drop:], rng.integers(0, 2 ** 63, add).astype("uint64")]
                if 100 * (n - drop) >= percent * (n + add):
                    (x, x_own), (y, y_own) = keys.of(np.unique(a)), keys.of(np.unique(b))
                    assert len(np.intersect1d(x[x_own], y)) or len(np.intersect1d(x, y[y_own]))


def test_sketches_never_rule_a_link_out():
    rng = np.random.default_rng(5)
    for n in (1, 7, 100, 700, 1030, 40000):
        for differ in (0, 1, n // 20, n // 5):
            pool = rng.integers(0, 2 ** 63, n + differ).astype("uint64")
            a, b = np.unique(pool[:n]), np.unique(pool[differ:])
            words = jaccard_join._folded([jaccard_join.sketch(a).tobytes(), jaccard_join.sketch(b).tobytes()])
            assert np.bitwise_count(words[0] ^ words[1]).sum() <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("block", [3, 2048])
def test_components_equal_brute_force(spark, block, monkeypatch):
    """A crowd of near copies around the threshold, in blocks of any size."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = np.random.default_rng(8)
    rows = []
    for i in range(90):
        words = [f"v{k}" for k in range(90 + i % 7)]
        for k in rng.choice(90, i % 6, replace=False):
            words[k] = f"n{int(rng.integers(0, 4))}"
        rows.append((i, " ".join(words), None, None, 0))
    sets = [set(s.tolist()) for s in jaccard_join.shingle_sets([r[1] for r in rows], 3)]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    out = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs(spark, rows), 3, 90).collect()}
    assert len(set(root)) > 5 and out == dict(enumerate(root))


def test_cut_block_whose_best_pair_was_tried(spark, monkeypatch):
    """Two crowds that few pairs link, while the pair with the nearest sketches does not and was tried before."""
    ids = lambda s: int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=16).digest()[:8], "little", signed=True)

    def crowds(seed):
        texts = []
        for i in range(24):
            words, side = [f"v{k}" for k in range(500)], i % 2
            for k in range(5 if i == 0 else 6):
                words[20 + 40 * k + 20 * side] = f"s{seed}n{i}k{k}"
            texts.append(" ".join(words))
        sets = jaccard_join.shingle_sets(texts, 5)
        far = {}
        for a in range(0, 24, 2):
            for b in range(1, 24, 2):
                words = jaccard_join._folded([jaccard_join.sketch(sets[a]).tobytes(), jaccard_join.sketch(sets[b]).tobytes()])
                far[a, b] = np.bitwise_count(words[0] ^ words[1]).sum() / (len(sets[a]) + len(sets[b]))
        return texts, sets, far

    linked = lambda s, t: 100 * len(np.intersect1d(s, t)) >= 80 * len(np.union1d(s, t))
    for seed in range(50):
        texts, sets, far = crowds(seed)
        best = min(far, key=far.get)
        if not linked(sets[best[0]], sets[best[1]]) and sorted(far.values())[1] > far[best]:
            break
    assert [p for p in far if linked(sets[p[0]], sets[p[1]])] == [(0, b) for b in range(1, 24, 2)]
    tried = [(i, i + 2) for i in range(22)] + [best]
    pairs = [tuple(sorted((ids(sets[a]), ids(sets[b])))) for a, b in tried]
    monkeypatch.setattr(jaccard_join, "_postings", lambda *_: spark.createDataFrame([(1, ids(s)) for s in sets], "key long, id long"))
    monkeypatch.setattr(jaccard_join, "_possible", lambda pairs, *_: pairs)
    monkeypatch.setattr(jaccard_join, "_chains", lambda _: spark.createDataFrame(pairs, "a long, b long"))
    out = jaccard_join.near_duplicates(docs(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)]), 5, 80).collect()
    assert {r["component_id"] for r in out} == {0}


def test_near_duplicates_of_odd_rows(spark):
    rows = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard_join.near_duplicates(docs(spark)).collect()}
    assert rows[2, 0] == 2 and rows[3, 0] == 3 and rows[4, 0] == 4 and rows[None, 2] == 1 and rows[7, 1] == 7
    n = next(k[1] for k in rows if k[0] == 5)
    assert rows[5, n] == rows[6, n] == 5


def test_chain_of_near_copies_is_one_component(spark):
    words, rows = [f"v{i}" for i in range(200)], []
    for i in range(120):
        words[i] = f"changed{i}"
        rows.append((1000 - i, " ".join(words), None, None, 0))
    out = jaccard_join.near_duplicates(docs(spark, rows), 3, 90).collect()
    assert {r["component_id"] for r in out} == {881}


def test_chunks_of_queries_are_even():
    import pandas as pd

    for n in (2, 5, 10, 50):
        sizes = np.bincount(knn_join._dealt(pd.Series(np.arange(0, 100000, 50)), n), minlength=n)
        assert sizes.min() > 0.6 * sizes.mean() and sizes.max() < 1.6 * sizes.mean()


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (8, [2.0]), (10, [-1.0, -1.0])]
    out = knn_join.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id = 0", 3).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in out] == [(8, 256 * 512), (1, 256 * 256 + 128 * 128), (2, 256 * 256 + 128 * 128)]


def test_pieces_equal_the_library(spark):
    import public_tokenizers
    import sentencepiece

    own = pieces.PieceModel(pieces.piece_model())
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(2)
    texts = ["", " ", "  a  b ", "\n\t x", "▁x", "日本語 é😀", "<s> </s>", "=" * 333, "ab" * 200, " " * 40, "x" * 3000]
    texts += ["".join(rng.choice(list("abe=- .\n▁é"), rng.integers(1, 60))) for _ in range(3000)]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)
        assert own.decode(ids) == library.decode(ids.tolist())
    for _ in range(500):
        ids = rng.integers(0, 400, rng.integers(1, 20)).tolist()
        assert own.decode(np.array(ids)) == library.decode(ids)
    for row in QUERIES["op4_pieces"](spark, TINY).join(spark.read.parquet(f"{TINY}/documents.parquet"), "doc_id").collect():
        ids = library.encode(row["text"], add_bos=True, add_eos=True)
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_of_odd_rows(spark):
    rows = pieces.encode_decode(docs(spark), pieces.piece_model()).collect()
    assert len(rows) == 9 and all(r["decoded"] == (r["text"] or "") and r["score"] == "x" for r in rows)


def _plain_dedup(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        lines, kept = text.split("\n"), []
        for a, b, n in line_dedup.chunks(text):
            chunk = "\n".join(lines[a:b])
            if n >= line_dedup.LONG_WORDS or b - a >= 2 and n >= line_dedup.MIN_WORDS:
                if chunk in seen:
                    continue
                seen.add(chunk)
            kept += lines[a:b]
        out[doc_id] = "\n".join(kept)
    return out


def test_line_dedup_equals_plain(spark):
    table = spark.read.parquet(f"{TINY}/documents.parquet")
    want = _plain_dedup([(r["doc_id"], r["text"]) for r in table.collect()])
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(table).collect()} == want


def _runs_elsewhere(rows):
    """Brute force: the lines (doc_id, line) of runs of 50 words that equal, line by line, a run in an earlier place."""
    places, gone = {}, set()
    for doc_id, text in sorted(rows):
        lines = text.split("\n")
        sizes = [len(x.split()) for x in lines]
        for i, line in enumerate(lines):
            for other, f in places.get(line, []) + [(lines, f) for f in range(i) if lines[f] == line]:
                if i and f and lines[i - 1] == other[f - 1] and other is not lines:
                    continue  # part of a match that began before
                limit, n, words = i - f if other is lines else len(lines), 0, 0
                while n < limit and i + n < len(lines) and f + n < len(other) and lines[i + n] == other[f + n]:
                    words += sizes[i + n]
                    n += 1
                if words >= 50:
                    gone |= {(doc_id, i + k) for k in range(n)}
        for f, line in enumerate(lines):
            places.setdefault(line, []).append((lines, f))
    return gone


def _without(rows, gone):
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}


def test_repeated_runs_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    pool = [" ".join(f"l{k}w{j}" for j in range(n)) for k, n in enumerate([0, 1, 3, 8, 12, 19, 25, 31, 40, 49, 50, 70])]
    passages = [[" ".join(f"p{p}l{k}w{j}" for j in range(60 // n)) for k in range(n)] for p, n in enumerate((1, 2, 3, 4, 6, 12, 30))]
    rows = []
    for d in range(60):
        lines = [f"own {d} {k}" if rng.random() < 0.4 else str(rng.choice(pool)) for k in range(int(rng.integers(1, 15)))]
        for _ in range(2):
            at = int(rng.integers(0, len(lines) + 1))
            lines[at:at] = passages[int(rng.integers(0, len(passages)))]
        rows.append((d, "\n".join(lines)))
    rows += [(60, "\n".join(["same ten words in every line of this one text"] * 23)), (61, "\n".join([pool[6]] * 9))]
    table = docs(spark, [(d, t, None, None, 0) for d, t in rows])
    gone = _runs_elsewhere(rows)
    out = line_dedup.dedup_lines(table, line_dedup.run_spans).collect()
    assert len(gone) > 200 and {r["doc_id"]: r["text"] for r in out} == _without(rows, gone)
    assert sum(r["lines_removed"] for r in out) == len(gone)


def test_repeated_passages_leave_the_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()]
    gone, seen = _runs_elsewhere(rows), set()
    for doc_id, text in sorted(rows):
        for a, b, n in line_dedup.chunks(text):
            chunk = "\n".join(text.split("\n")[a:b])
            if n >= 50 or b - a >= 2 and n >= 10:
                gone |= {(doc_id, i) for i in range(a, b)} if chunk in seen else set()
                seen.add(chunk)
    assert {r["doc_id"]: r["text"] for r in QUERIES["op6_line_dedup"](spark, TINY).collect()} == _without(rows, gone)


def test_line_dedup_of_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"head one\n{passage}\ntail", "a", "b", 1), (2, f"{passage}\nmore", None, None, 1), (3, "own words here", None, None, 1), (4, None, None, None, 1),
            (None, passage, None, None, 1), (3, "own words here", None, None, 1), (5, "", None, None, 1)]
    out = line_dedup.dedup_lines(docs(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["text"], r["lines_removed"]) for r in out if r["text"] is not None) == sorted(
        [("1", f"head one\n{passage}\ntail", 0), ("2", "more", 1), ("3", "own words here", 0), ("3", "own words here", 0), ("None", "", 1), ("5", "", 0)])
    assert [r["text"] for r in out if r["doc_id"] == 4] == [None] and all(r["score"] == "x" for r in out)


def test_licenses_and_inheritance(spark):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.py", "code " * 30), (3, "a/b/c/y.py", "code"), (4, "z/y.py", "code"),
            (5, "a/b/z.py", "text here\nLicensed under the Apache License, Version 2.0.\n" + "code " * 40), (6, None, None), (7, "a/e", "")]
    out = {r["file_key"]: (r["license"], r["inherited_from"]) for r in licenses.scan(spark.createDataFrame(rows, "file_key long, path string, text string")).collect()}
    assert out == {1: ("MIT", None), 2: ("MIT", "a"), 3: ("MIT", "a"), 4: (None, None), 5: ("Apache-2.0", None), 6: (None, None), 7: ("MIT", "a")}


def _wrapped(text, mark, width=40):
    import textwrap

    return "\n".join(f"{mark} {line}" for line in textwrap.wrap(text, width))


LICENSED = [
    ("// SPDX-License-Identifier: MIT\nint main() {}", "MIT"), ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("/* SPDX-License-Identifier: GPL-3.0-or-later */", "GPL-3.0"),
    ("# SPDX-License-Identifier: LGPL-2.1-only", "LGPL-2.1"), ("# SPDX-License-Identifier: Unheard-1.0", None),
    ("Copyright (c) 2020 Jane Doe. Released under the MIT License. It does this and that.", "MIT"),
    (_wrapped(licenses.TEMPLATES["GPL-3.0"][2], "#"), "GPL-3.0"), (_wrapped(licenses.TEMPLATES["LGPL-3.0"][2], " *"), "LGPL-3.0"), (_wrapped(licenses.TEMPLATES["AGPL-3.0"][2], "//"), "AGPL-3.0"),
    (_wrapped(licenses.TEMPLATES["Apache-2.0"][2], "#", 70) + "\nimport os\n" + "x = 1\n" * 50, "Apache-2.0"), ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "LGPL-3.0"),
    ("Copyright 2021 Someone\n" + _wrapped(licenses.TEMPLATES["MIT"][2], "", 60), "MIT"), (_wrapped(licenses.TEMPLATES["BSD-2-Clause"][0], "*"), "BSD-2-Clause"),
    (_wrapped(licenses.TEMPLATES["BSD-3-Clause"][0], "*"), "BSD-3-Clause"), (_wrapped(licenses.TEMPLATES["ISC"][1], ";"), "ISC"), (_wrapped(licenses.TEMPLATES["MPL-2.0"][1], "//"), "MPL-2.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("The public may redistribute the source of this river without any warranty of the water.", None), ("He was granted a license to drive under the law of the land.", None), ("", None), (None, None),
]


def _prose():
    rng = np.random.default_rng(1)
    words = "the of to and in a is it that for was on are with as be this by or from at code value return if not all any software work".split() + [f"w{i}" for i in range(80)]
    return [" ".join(rng.choice(words, 60)) for _ in range(60)]


def test_licenses_are_found_and_told_apart(spark):
    rows = [(i, f"p{i}/x", t) for i, (t, _) in enumerate(LICENSED)] + [(100 + i, f"q{i}/x", t) for i, t in enumerate(_prose())]
    table = spark.createDataFrame([(*r, "own", 1.0, "x") for r in rows], "file_key long, path string, text string, license string, cosine double, dir string")
    out = {r["file_key"]: r for r in licenses.scan(table).collect()}
    assert [out[i]["license"] for i in range(len(LICENSED))] == [name for _, name in LICENSED]
    assert not [t for i, t in enumerate(_prose()) if out[100 + i]["license"]]
    assert all((out[i]["cosine"] is None) == (name is None) for i, (_, name) in enumerate(LICENSED))


def test_license_windows_equal_brute_force():
    """All windows that begin with a word of the template, compared one by one."""
    rng = np.random.default_rng(3)
    texts = [t or "" for t, _ in LICENSED] + _prose()[:5]
    whole = [licenses.terms(t) for texts_ in licenses.TEMPLATES.values() for t in texts_]
    for _ in range(40):  # pieces of templates with words lost, put in and said twice
        found = []
        for _ in range(int(rng.integers(1, 4))):
            t = whole[int(rng.integers(len(whole)))]
            a = int(rng.integers(0, len(t)))
            found += [w for w in t[a:a + int(rng.integers(1, 120))] if rng.random() > 0.1]
            found += list(rng.choice(["foo", "the", "license", "bar"], int(rng.integers(0, 6))))
        texts.append(" ".join(found))
    counts = {t: int(n) for t, n in zip(licenses._vocabulary(), rng.integers(0, 500, len(licenses._vocabulary())))}
    templates = licenses.Templates(counts, 500)
    for text in texts:
        found = licenses.terms(text)
        best, covered = (0.0, None), set()
        numbers = np.array([templates.vocabulary.get(t, -1) for t in found], "int64")
        for k, name in enumerate(templates.names):
            for at in range(len(found)):
                if numbers[at] >= 0 and templates.weights[k, numbers[at]] > 0:
                    window = found[at:at + templates.sizes[k]]
                    weights = {t: window.count(t) * (templates.idf[templates.vocabulary[t]] if t in templates.vocabulary else 0) for t in set(window)}
                    length = np.sqrt(sum(w * w for w in weights.values()) + sum(t not in templates.vocabulary for t in window) * templates.other ** 2)
                    cosine = sum(w * templates.weights[k, templates.vocabulary[t]] for t, w in weights.items() if w) / (length * templates.lengths[k])
                    if cosine >= licenses.LEAST_COSINE:
                        covered |= set(range(at, min(at + templates.sizes[k], len(found))))
                        if cosine > best[0] + 1e-9:
                            best = cosine, name
        got = templates.search(found)
        assert got[1] == best[1] and abs(got[0] - best[0]) < 1e-9 and got[2] == len(covered)


def test_license_scan_of_odd_files(spark):
    text = "Released under the MIT License."
    rows = [(1, "a/x", text), (1, "a/x", text), (None, "a/y", "code"), (2, None, text), (3, "top", text), (4, "b/c/d", LONG + " " + text), (5, "b/c/e", None)]
    out = licenses.scan(spark.createDataFrame(rows, "file_key long, path string, text string")).collect()
    assert sorted((str(r["file_key"]), r["license"], str(r["inherited_from"])) for r in out if r["license"]) == [
        ("1", "MIT", "None"), ("1", "MIT", "None"), ("2", "MIT", "None"), ("3", "MIT", "None"), ("4", "MIT", "None"), ("None", "MIT", "a")]


def test_warc_round_trip_of_odd_pages(spark, monkeypatch):
    rows = [(3, "http://a/b c", "<p>x\r\n\r\ny</p>"), (1, None, "<p>x\r\n\r\ny</p>"), (2, "http://é/", None), (4, "u", ""), (5, "u", "é" * 100000), (None, "n", "n")]
    folder = fresh_path(spark, "warc")
    index = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    out = {r["page_id"]: r for r in warc.read(index, folder).collect()}
    assert bytes(out[1]["payload"]) == b"<p>x\r\n\r\ny</p>" and out[3]["payload"] is None and out[3]["refers_to"] == 1 and out[3]["payload_bytes"] == 13
    assert out[4]["refers_to"] == 2 and out[2]["payload_bytes"] == 0 and out[5]["payload_bytes"] == 200000 and None in out
    monkeypatch.setattr(warc, "STRETCH", 1 << 8)
    again = {r["page_id"]: r for r in warc.read(index, folder).collect()}
    assert again == out and warc.read(index, folder).rdd.getNumPartitions() >= 3
    assert warc.ranges([0, 10, 200000], [10, 5, 7]) == [(0, 2, 0, 15), (2, 3, 200000, 7)]


def _plain_kernel(a, b):
    """Sum over common subsequences, each with the sum of its weights in either word."""
    def found(word):
        rows, lengths, _ = toxicity.spell([word])
        letters, out = rows[0][:lengths[0]].tolist(), {}
        for n in toxicity.LENGTHS:
            for places in itertools.combinations(range(len(letters)), n):
                if places[-1] - places[0] < toxicity.SPAN:
                    code = tuple(letters[i] for i in places)
                    out[code] = out.get(code, 0) + toxicity.DECAY ** (places[-1] - places[0] + 1)
        return out

    x, y = found(a), found(b)
    product = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return product(x, y) / np.sqrt(product(x, x) * product(y, y))


def test_kernel_equals_brute_force():
    words = ["papapapa", "banana", "bananas", "idiot", "id-iot", "abcabcabc", "mississippi", "xy", "ab" * 12, "wonder"]
    k = toxicity.kernel(words, words)
    assert np.allclose(k, [[_plain_kernel(a, b) for b in words] for a in words], atol=1e-5)
    assert np.allclose(np.diag(k), 1, atol=1e-5)


def test_long_words_are_learnt_whole():
    """A toxic word of more than a piece, whose beginning clean words share, and its disguise with marks between all letters."""
    rng = np.random.default_rng(2)
    head, bad = "interconnectednessfulnes", "wuzzlegrumpf"
    clean = ["".join(rng.choice(list("bcdlmnrst")) + rng.choice(list("aeo")) for _ in range(4)) for _ in range(300)]
    bags = []
    for i in range(400):
        bag = list(rng.choice(clean, 20))
        bag.append(head + (bad if i % 4 == 0 else str(rng.choice(clean))))
        bags.append(bag)
    model = toxicity.fit(bags, [int(i % 4 == 0) for i in range(400)])
    p = model.probability(model.margins([head + bad, head + clean[0], ".".join(bad + bad)]))
    assert p[0] > 0.9 and p[1] < 0.1 and p[2] > 0.9


def test_kernel_tolerates_gaps():
    k = toxicity.kernel(["idiot", "id-iot", "idxiot", "wonder"], ["idiot"])[:, 0]
    assert k[0] > k[1] > 3 * k[3] and k[2] > 3 * k[3]
    assert "idiot" in toxicity.words_of("you i d i o t there")


def test_toxicity_learns_and_holds_out(spark):
    rng = np.random.default_rng(1)
    clean = ["".join(rng.choice(list("bcdlmnrst")) + rng.choice(list("aeo")) for _ in range(3)) for _ in range(400)]
    rows = []
    for i in range(600):
        text = list(rng.choice(clean, 30))
        if i % 5 == 0:
            text.insert(7, str(rng.choice(["idiot", "wizzpuk", "wizzpukes"])))
        rows.append((i, " ".join(text), None, None, 0))
    table = docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int")
    out = toxicity.score(table, toxicity.learn(table, labels)).where("doc_id >= 400").collect()
    assert np.mean([r["predicted"] == (r["doc_id"] % 5 == 0) for r in out]) > 0.97
    odd = toxicity.score(docs(spark), toxicity.learn(table, labels)).collect()
    assert len(odd) == 9 and all(0 <= r["score"] <= 1 for r in odd)


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark):
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(40))
    near, other = text + " more", " ".join(f"o{i}" for i in range(40))
    rows = [(5, text), (3, near), (3, other), (None, text), (None, text), (None, other + " x"), (7, None), (7, None), (8, ""), (9, "lone words"), (9, "lone words"), (None, "alone")]
    table = docs(spark, [(i, t, None, None, 0) for i, t in rows])
    out = corpus_pipeline.drop_near_duplicates(spark, table, TINY)
    assert out.columns == table.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(3, near), (3, other), (7, None), (7, None), (8, ""), (9, "lone words"), (None, "alone")], key=str)
    assert corpus_pipeline.drop_near_duplicates(spark, docs(spark, []), TINY).count() == 0


def test_pipeline_of_odd_rows(spark, monkeypatch):
    """Nulls, empty and very long texts, repeated rows, clashing columns and no rows at all pass every stage."""
    import corpus_pipeline
    from millwatch.plans.storage import written

    for rows in (None, []):
        table = docs(spark, rows)
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            before, table = table, written(stage(spark, table, TINY), "odd")
            assert i == len(corpus_pipeline.STAGES) - 1 or table.columns == before.columns
        assert table.count() == 0 if rows == [] else table.count() > 0


def test_pipeline_stages(spark):
    import corpus_pipeline
    from millwatch.plans.storage import written

    table = spark.read.parquet(f"{TINY}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, table = table, written(stage(spark, table, TINY), f"test-{name}")
        assert i == len(corpus_pipeline.STAGES) - 1 or table.columns == before.columns
        if name in ("toxicity", "jaccard_join"):
            assert table.join(before, table.columns, "left_anti").count() == 0 and table.count() > 0.5 * before.count()
        if name == "jaccard_join":
            assert jaccard_join.near_duplicates(table, 5, 80).where("doc_id <> component_id").count() == 0
    assert table.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and table.count() > 0
