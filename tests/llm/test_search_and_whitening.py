"""Ranked search by presence masks and whitening, against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import mask_search, whitening
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


# -- search ---------------------------------------------------------------------------------


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_ranks(docs, items, k):
    """Rows of (item_id, rank, doc_id, score), each equal item row once."""
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, words = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        asked = set(plain_terms(text))
        found = []
        for i, c in held:
            middle = 100 - 50 + 50 * c.total() * n // words
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * middle)) for t in asked if t in c)
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k])]
    return sorted(out, key=str)


def ranked(docs, items, **how):
    return sorted(map(tuple, mask_search.top_documents(docs, items, **how).collect()), key=str)


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def test_search_query_agrees_with_plain_version(spark):
    docs = [tuple(r) for r in table(spark, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, "benchmark").select("item_id", "text").collect()]
    got = QUERIES["op12_mask_search"](spark, FOLDER)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == plain_ranks(docs, items, 50)


@pytest.mark.parametrize("name, value", [("SHARD_DOCUMENTS", 7), ("SHARD_POSTINGS", 60), ("BLOCK_ITEMS", 2), ("SENT_TERMS", 3), ("OPEN_BYTES", 100), ("SCORED_FIRST", 1)])
def test_search_does_not_depend_on_sizes(spark, monkeypatch, name, value):
    monkeypatch.setattr(mask_search, name, value)
    rng = random.Random(3)
    text = lambda most: " ".join(rng.choice("abcdefghij") * rng.choice([1, 1, 2]) for _ in range(rng.randrange(most)))
    docs, items = [(i, text(20)) for i in range(150)], [(i, text(9)) for i in range(8)]
    items.append((100, " ".join(f"w{i}" for i in range(90)) + " a bb c"))
    docs += [(200 + i, " ".join(f"w{rng.randrange(90)}" for _ in range(30))) for i in range(40)]
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    assert ranked(*frames, k=5) == plain_ranks(docs, items, 5)


def test_groups_are_left_out_by_their_bound(spark, monkeypatch):
    """One document has all terms; those of the other masks cannot reach it and are never scored."""
    docs = [(0, "a b c d"), *[(i, "abcd"[i % 4] + " x y z") for i in range(1, 200)]]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    row = mask_search._shard_rows(frame, "doc_id", "text", None).first().asDict()
    shard = mask_search.Shard(row, row["n"], row["words"])
    scored = []
    monkeypatch.setattr(mask_search, "SCORED_FIRST", 1)
    monkeypatch.setattr(mask_search.Shard, "scores", lambda self, places, plain=mask_search.Shard.scores: scored.append(len(places)) or plain(self, places))
    best = shard.search({t: mask_search.weight(200, 50) for t in "abcd"}, 1, [])
    assert [b[2] for b in best] == [0] and sum(scored) == 1


def test_search_odd_rows(spark):
    docs = [
        (5, "One two"), (3, "ONE,two"), (3, "ONE,two"), (None, "one two"), (7, None), (8, ""), (9, " ,.;\n"), (10, "É é one"), (11, "é1 É"),
        (12, "one " * 30000 + "rare"), (13, "KK İ one\x00two"),
    ]
    items = [(1, "one TWO one"), (1, "one TWO one"), (1, "é"), (2, None), (3, ""), (4, "..."), (None, "rare zzz"), (6, "missing"), (7, "K")]
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, terms string, item_id int, n int")
    asked = spark.createDataFrame([(i, t, 9, 8) for i, t in items], "item_id long, text string, doc_id int, terms int")
    assert ranked(frame, asked, k=4) == plain_ranks(docs, items, 4)
    assert mask_search.top_documents(frame.limit(0), asked).count() == 0 == mask_search.top_documents(frame, asked.limit(0)).count()
    named = frame.selectExpr("concat('d', doc_id) AS doc_id", "text")
    texts = [r[2] for r in sorted(map(tuple, mask_search.top_documents(named, asked.where("text = 'one TWO one'"), k=6).collect()), key=lambda r: r[1])]
    assert texts == ["d13", "d3", "d3", "d5", None, "d12"]


# -- whitening ------------------------------------------------------------------------------


def plain_grid(v):
    if v is None or any(c is None or not math.isfinite(c) for c in v):
        return None
    return tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)


def plain_whitened(rows, most=16, counted=False):
    """By id the deviation and whitened values, explained shares, and n, for vectors of one length."""
    kept = [(i, plain_grid(v)) for i, v in rows]
    kept = [(i, x) for i, x in kept if x]
    copies = Counter(x for _, x in kept)
    xs = list(copies)
    weights = np.array([copies[x] if counted else 1 for x in xs])
    n, sums = int(weights.sum()), [sum(int(w) * x[j] for w, x in zip(weights, xs)) for j in range(len(xs[0]))]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in xs])
    values, vectors = np.linalg.eigh((centred * weights[:, None]).T @ centred / n)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    made = dict(zip(xs, centred @ vectors / np.sqrt(values)))
    apart = {x: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for x in xs}
    return [(i, apart[x], made[x]) for i, x in kept], values / np.trace((centred * weights[:, None]).T @ centred / n), n


def gathered(frame):
    by_row = {}
    for r in frame.collect():
        by_row.setdefault(r.vec_id, {})[r.component] = r
    return by_row


def same_whitening(got, want, shares, n):
    signs = np.zeros(len(shares))
    assert len(got) == len({i for i, _, _ in want})
    for i, apart, values in want:
        assert sorted(got[i]) == list(range(1, len(shares) + 1))
        mine = np.array([got[i][c].whitened for c in sorted(got[i])])
        signs = np.where(signs == 0, np.sign(mine * values) * (np.abs(values) > 1e-6), signs)
        assert np.allclose(mine, np.where(signs == 0, 1, signs) * values, atol=1e-5)
        for c, r in got[i].items():
            assert (r.n, r.deviation) == (n, apart) and r.explained == pytest.approx(shares[c - 1], rel=1e-6) and r.identity_error <= 1e-6


def test_whitening_query_agrees_with_plain_version(spark):
    rows = [tuple(r) for r in table(spark, "embeddings").select("vec_id", "embedding").collect()]
    got = QUERIES["op13_whitening"](spark, FOLDER)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    same_whitening(gathered(got), *plain_whitened(rows))


@pytest.mark.parametrize("counted", (False, True))
def test_whitening_with_copies_and_weights(spark, counted):
    rng = np.random.default_rng(4)
    base = (rng.standard_normal((60, 6)) * [5, 4, 3, 2, 1, 0.5] + 3).astype(np.float32).tolist()
    rows = [(i, base[i % 60 if i < 90 else 7]) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    same_whitening(gathered(whitening.whiten(frame, most=4, counted=counted)), *plain_whitened(rows, 4, counted))


def test_whitening_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 100)
    monkeypatch.setattr(whitening, "SHARES", 2)
    rows = [(i, np.random.default_rng(i).standard_normal(5).astype(np.float32).tolist()) for i in range(90)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    same_whitening(gathered(whitening.whiten(frame)), *plain_whitened(rows))


def test_whitening_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 2.0]), (1, [1.0, 0.0, 2.0]), (None, [0.0, 1.0, 5.0]), (3, [1.001, 0.0, 2.0]), (4, None), (5, [nan, 1.0, 1.0]), (6, [inf, 1.0, 1.0]),
        (7, [None, 1.0, 1.0]), (8, []), (9, [4.0, 4.0]), (10, [3e38, 0.0, 0.0]), (11, [-3.0, 2.0, 7.0]),
    ]
    frame = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id long, embedding array<float>, x string, n int, component int")
    out = whitening.whiten(frame).collect()
    assert Counter(r.vec_id for r in out) == {1: 6, None: 3, 3: 3, 9: 2, 11: 3}
    three = [r for r in out if r.vec_id in (1, 3, 11, None)]
    assert {r.n for r in three} == {3}
    assert all((r.whitened is None) == (r.component == 3) and (r.explained == 0.0) == (r.component == 3) for r in three)
    alone = [r for r in out if r.vec_id == 9]
    assert all((r.n, r.deviation, r.whitened, r.explained) == (1, 0, None, 0.0) for r in alone)
    assert {r.identity_error < 1e-9 for r in out} == {True}
    assert whitening.whiten(frame.limit(0)).count() == 0


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(1, [3e16, 0.0]), (2, [-3e16, 1.0]), (3, [0.5, 2.0])]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    grid = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in rows}
    sums = [sum(x[j] for x in grid.values()) for j in (0, 1)]
    for r in out:
        exact = sum((3 * c - s) ** 2 for c, s in zip(grid[r.vec_id], sums))
        assert r.deviation == (exact if exact < 1 << 63 else None)
    assert {r.deviation is None for r in out} == {True, False}
