"""Lexical search, suffix dedup and whitening against plain versions, and on rows that have something odd."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest import TINY

from millwatch.llm import lexical, suffix_dedup, whitening
from millwatch.llm.queries import QUERIES

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30000))
ODD = "doc_id long, text string, removed_spans string, kept int, row string, d long, tag string, c long"


def docs(spark, rows):
    """Columns with names that the operators use inside."""
    return spark.createDataFrame([(*r, "x", 1, "y", 2, "t", 3) for r in rows], ODD)


# suffix dedup


def plain_cut(rows: list[tuple[int | None, str | None]], length: int) -> list[bytes]:
    raw = [(i, (t or "").encode()) for i, t in rows]
    least: dict[bytes, int] = {}
    for i, t in raw:
        for p in range(len(t) - length + 1):
            if i is not None:
                least[t[p:p + length]] = min(least.get(t[p:p + length], i), i)
    out = []
    for i, t in raw:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            first = least.get(t[p:p + length])
            if first is not None and (i is None or first < i):
                gone[p:p + length] = b"\1" * length
        out.append(bytes(b for b, g in zip(t, gone) if not g))
    return out


def cut_rows(spark, rows, length=50):
    out = suffix_dedup.remove_copied_bytes(docs(spark, rows), length).collect()
    assert len(out) == len(rows)
    for r in out:
        raw, at, kept = (r["text"] or "").encode(), 0, b""
        for span in r["removed_spans"]:
            assert at < span["start"] + (at == 0) and span["start"] < span["end"] <= len(raw)
            kept, at = kept + raw[at:span["start"]], span["end"]
        assert kept + raw[at:] == bytes(r["kept"])
        assert (r["row"], r["d"], r["tag"], r["c"]) == ("y", 2, "t", 3)
    return sorted(((r["doc_id"] is None, r["doc_id"], r["text"]), bytes(r["kept"])) for r in out)


def expected_cut(rows, length=50):
    return sorted(((i is None, i, t), k) for (i, t), k in zip(rows, plain_cut(rows, length)))


@pytest.mark.parametrize("seed, letters, length", [(0, "aß", 50), (4, "abcdefgh", 67)])
def test_copied_bytes_equal_brute_force(spark, seed, letters, length):
    """Pieces of a few common strings, cut anywhere, among noise: copies of every length around the threshold."""
    rng = np.random.default_rng(seed)
    say = lambda n: "".join(rng.choice(list(letters), n))
    common = [say(200) for _ in range(3)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(int(rng.integers(0, 5))):
            whole, a = common[int(rng.integers(0, 3))], int(rng.integers(0, 150))
            parts += [say(int(rng.integers(0, 30))), whole[a:a + int(rng.integers(20, 150))]]
        rows.append((int(i * 7 % 61), "".join(parts)))
    assert cut_rows(spark, rows, length) == expected_cut(rows, length)


def test_copied_bytes_of_odd_rows(spark):
    line = "the quick brown fox jumps over the lazy dog and then sleeps all day"
    rows = [(1, line), (1, line), (1, line + " twice"), (2, None), (3, ""), (None, line), (None, line), (4, LONG), (5, LONG + line), (6, line[:49]), (7, line[:50]), (7, "x" + line[:50])]
    assert cut_rows(spark, rows) == expected_cut(rows)
    assert suffix_dedup.remove_copied_bytes(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_copied_bytes(docs(spark, []), 40)


def test_copies_of_whole_texts_are_not_refined(spark):
    """What only equal texts share has no anchors to go on with; their copies are found as a whole."""
    rows = spark.createDataFrame([(1, 10, b"a" * 30 + LONG[:900].encode()), (2, 10, b"a" * 30 + LONG[:900].encode()), (3, 30, LONG[3000:3900].encode())],
                                 "d long, tag long, text binary")
    firsts = rows.where("d <> 2").select("d", "tag")
    assert suffix_dedup._survivors(rows, firsts, 50).count() == 0
    assert cut_rows(spark, [(i, LONG[:900]) for i in (1, 2, 3)]) == expected_cut([(i, LONG[:900]) for i in (1, 2, 3)])


@pytest.mark.parametrize("later", [False, True])
def test_entries_meet_in_packs(spark, monkeypatch, later):
    """Keys that few or all documents have, in many packs, with equal first and different second keys, against a plain count."""
    monkeypatch.setattr(suffix_dedup, "HELD", 200)
    monkeypatch.setattr(suffix_dedup, "PACK_BITS", 4)
    df = spark.createDataFrame([(d, b"x") for d in range(3000)], "d long, text binary").repartition(5)
    keys = 1 if not later else 2

    def entries(d):
        first = np.where(d % 3 == 0, 7, (d * 2654435761 % 4001 % 2500) << 52).astype("uint64")
        return [first, (d % 2).astype("uint64"), d, d * 10] if later else [first, d]

    def emit(part, text):
        return entries(part.column("d").to_numpy())

    kinds = {"k": "uint64", "k2": "uint64", "d": "int64", "c": "int64"} if later else {"k": "uint64", "d": "int64"}
    out = ["c"] if later else ["d", "k"]
    got = sorted(map(tuple, suffix_dedup._met(df, "text", kinds, keys, out, later, emit).collect()))
    rows = list(zip(*(c.tolist() for c in entries(np.arange(3000)))))
    groups = {}
    for r in rows:
        groups.setdefault(r[:keys], []).append(r)
    if later:
        want = [(r[3],) for g in groups.values() for r in g if r[2] > min(x[2] for x in g)]
    else:
        want = [(r[1], r[0] - (1 << 64) * (r[0] >> 63)) for g in groups.values() if len(g) > 1 for r in g]
    assert got == sorted(want) and 0 < len(want) < 3000


def test_identifiers_refine_by_later_offsets():
    texts = [b"0123456789" * 20, b"", b"abc" + b"0123456789" * 20]
    text = suffix_dedup.Bytes(texts)
    whole = b"".join(texts)
    for depth in (16, 32, 50, 67):
        ids = text.all_at(depth, 0)
        assert (ids == text.at(np.arange(len(whole) - depth + 1), depth, 0)).all()
        names = {}
        for p, i in enumerate(ids.tolist()):
            assert names.setdefault(whole[p:p + depth], i) == i
        assert len(set(names.values())) == len(names)
    start, anchor, _ = text.windows(50)
    assert len(start) == 151 + 154 and ((anchor >= start) & (anchor <= start + 34)).all()


# lexical search


def plain_search(rows, items, k):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    found = [(i, Counter(terms(t))) for i, t in rows]
    n_docs, total = sum(bool(c) for _, c in found), sum(sum(c.values()) for _, c in found)
    holding = Counter(t for _, c in found for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, c in found:
            n, score = sum(c.values()), 0
            for t in wanted & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * (100 - 50 + (50 * n * n_docs) // total)))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, at + 1, None if none else i, -s) for at, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def ranked(spark, rows, items, k):
    told = spark.createDataFrame([(*r, 0, 0) for r in items], "item_id long, text string, doc_id int, score int")
    return sorted((tuple(r) for r in lexical.search(docs(spark, rows), told, k).collect()), key=str)


@pytest.mark.parametrize("block, tile", [(512, 2048), (3, 2)])
def test_search_equals_brute_force(spark, block, tile, monkeypatch):
    """Ties by repeated texts, nulls, empty and very long texts, in blocks and tiles of any size."""
    monkeypatch.setattr(lexical, "ITEM_BLOCK", block)
    monkeypatch.setattr(lexical, "TERM_TILE", tile)
    monkeypatch.setattr(lexical, "DOC_TILE", 8)
    rng = np.random.default_rng(4)
    words = ["alpha", "BETA", "Éclair", "éclair", "x1", "naïve", "ΣΑΣ", "σας", "the", "of", "a", "zz"]
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(0, 9))))) for i in range(70)]
    rows += [(100 + i, "beta, THE-of") for i in range(9)] + [(3, "beta, THE-of"), (3, "beta, THE-of"), (None, "beta, THE-of"), (None, None), (200, ""), (201, " ,;\x00\x7f"), (202, LONG), (203, LONG + " beta")]
    items = [(i, " ".join(rng.choice(words, 3))) for i in range(6)] + [(0, "w1x1 beta"), (None, "the"), (8, None), (9, ""), (10, "nowhere"), (11, "beta beta of w3x3")]
    for k in (5, 50):
        assert ranked(spark, rows, items, k) == plain_search(rows, items, k)


def test_search_of_empty_tables(spark):
    assert ranked(spark, [], [(1, "a")], 5) == ranked(spark, [(1, "a")], [], 5) == ranked(spark, [(1, "a")], [(1, None)], 5) == []


def test_products_are_exact():
    rng = np.random.default_rng(2)
    weight, impact = rng.integers(1, 30000, (7, 5000)), rng.integers(1, lexical.IMPACT, (11, 5000))
    pairs = [(np.repeat(np.arange(len(m)), 5000), np.tile(np.arange(5000), len(m)), m.ravel()) for m in (impact, weight)]
    assert (lexical.product(*pairs, 11, 7) == weight @ impact.T).all()


# whitening


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1.0, 3) for r in rows], "vec_id long, embedding array<float>, whitened string, deviation double, row int")


def check_whitening(rows, out, model, error, k):
    from fractions import Fraction

    x = np.array([np.floor(64 * np.array(v, "float32").astype("float64")) for _, v in rows]) + 1_000_000
    n, sums = len(x), x.sum(0)
    v = np.cov(x.T, bias=True).reshape(x.shape[1], -1)
    values = np.linalg.eigvalsh(v)[::-1]
    assert model.n == n and model.sums == [int(s) for s in sums]
    assert np.allclose(model.eigenvalues, values[:len(model.eigenvalues)], rtol=1e-9)
    assert np.allclose(v @ model.components, model.components * model.eigenvalues, atol=1e-9 * values[0])
    assert len(model.eigenvalues) <= k and error < 1e-8
    by = {r["vec_id"]: r for r in out}
    assert len(out) == n
    for (i, _), row in zip(rows, x):
        assert by[i]["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))
        assert np.allclose(by[i]["whitened"], (row - np.array([float(Fraction(int(s), n)) for s in sums])) @ model.components / np.sqrt(model.eigenvalues), atol=1e-7)


@pytest.mark.parametrize("width, rank, n", [(8, 8, 300), (40, 40, 500), (20, 5, 200), (6, 6, 4), (1, 1, 30)])
def test_whitening_equals_a_plain_one(spark, width, rank, n):
    rng = np.random.default_rng(width)
    base = rng.integers(-3, 4, (n, rank)).astype(float) @ rng.integers(-2, 3, (rank, width)) if rank < width else rng.normal(size=(n, width)) * np.linspace(0.1, 5, width)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    df = vectors(spark, rows)
    out, model, error = whitening.whiten(df.repartition(5))
    assert out.columns == ["vec_id", "embedding", "row", "deviation", "whitened"]
    check_whitening(rows, out.collect(), model, error, 32)
    again = whitening.fit(df.coalesce(1))
    assert (again.components == model.components).all() and (again.eigenvalues == model.eigenvalues).all()


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(9)
    good = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 6)))]
    bad = [(100, None), (101, [1.0] * 5 + [None]), (102, [float("nan")] * 6), (103, [float("inf")] + [0.0] * 5), (None, good[0][1]), (0, good[0][1]), (105, [1.0, 2.0]), (106, [])]
    out, model, error = whitening.whiten(vectors(spark, good + bad))
    rows = out.collect()
    assert len(rows) == 54 == model.n and error < 1e-8
    assert {r["vec_id"] for r in rows} == {*range(50), None, 105, 106}
    same = [r["whitened"] for r in rows if r["vec_id"] in (0, None)]
    assert len(same) == 3 and same[0] == same[1] == same[2]
    short = next(r["whitened"] for r in rows if r["vec_id"] == 105)
    x = np.array([[np.floor(64 * np.float64(np.float32(c))) for c in [1, 2, 0, 0, 0, 0]]]).astype("int64") + whitening.SHIFT
    assert np.allclose(short, model.whitened(x)[0])
    assert whitening.whiten(vectors(spark, bad[:4]))[1] is None and whitening.whiten(vectors(spark, []))[0] is None
    alone, model, error = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]))
    assert [r["whitened"] for r in alone.collect()] == [[], []] and error == 0.0


def test_products_of_large_numbers_are_exact():
    x = np.array([[3_000_000_000, 1], [-2_999_999_999, 5], [7, 11]])
    assert (whitening._products(x) == x.astype(object).T @ x.astype(object)).all()


def test_whitening_query(spark):
    rows = QUERIES["op13_whitening"](spark, TINY).toPandas()
    import pyarrow.parquet as pq

    table = pq.read_table(f"{TINY}/embeddings.parquet").to_pandas()
    x = np.floor(64 * np.stack(table.embedding).astype("float64")) + 1_000_000
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert len(rows) == len(x) * 32 and (rows.n == len(x)).all() and rows.identity_error.max() < 1e-8
    assert np.allclose(rows[rows.vec_id == table.vec_id[0]].sort_values("component").explained, values[:32] / values.sum(), rtol=1e-8)
