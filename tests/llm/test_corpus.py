"""Mixing, scoring, search and the pipeline against SQL and brute force."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tidemark.llm import bm25, katz, mixing
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES

from test_near_duplicates import plain_kept

FOLDER = "/root/testdata/sf0.001"


def table(spark, name="documents"):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def test_registration():
    assert QUERIES.keys() | {"pipeline"} <= driver.queries().keys()
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert ORACLE.keys() <= QUERIES.keys() and ORACLE.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{FOLDER}/{file}')")
    want = connection.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(names)
    plain = lambda rows: sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)
    assert plain(map(tuple, got.select(*names).collect())) == plain(want.fetchall())


# -- mixing ---------------------------------------------------------------------------------


def shared_out(sizes, weights=(5, 2, 1)):
    """Targets by handing out the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, rest, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), set(order)
    while rest > 1e-9 and open_:
        per = rest / sum(weigh[s] for s in open_)
        rest = 0.0
        for s in sorted(open_, key=str):
            target[s] += per * weigh[s]
            if target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def sources(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), f"s{i % 4}" if i % 9 else None, 1, 2) for i in range(400)]
    rows += [(1000 + i, None, "empty", 1, 2) for i in range(3)] + [(2000 + i, "a b c", "tiny", 1, 2) for i in range(2)] + [(2000, "a b c", "tiny", 1, 2), (None, "a b", "tiny", 1, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, copies int, target int")


def test_mix_meets_its_targets(spark):
    docs = sources(spark)
    got = mixing.mix(docs)
    rows = got.join(docs.select("doc_id", "source"), "doc_id").dropDuplicates(["doc_id"]).collect()
    assert got.count() == docs.count()
    size_of, taken, longest, target = Counter(), Counter(), Counter(), {}
    for r in docs.select("source", "text").collect():
        n = len((r.text or "").split())
        size_of[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    for r in rows:
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
        assert 0 <= r.copies <= 2 and r.source_size == size_of[r.source]
    want = shared_out(size_of)
    for s in size_of:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        if s != "tiny":
            assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6


def test_certain_documents_and_rescaled_odds(spark):
    """One source of which a quarter more is wanted: its large documents come twice, others by odds scaled to the rest."""
    sizes = [400] + [10] * 60 + [1] * 40
    rows = [(i, " ".join(["w"] * n), "s") for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = 1.5 * sum(sizes) - sum(sizes)
    certain, rest = [], sorted(set(sizes), reverse=True)
    scale = lambda out: (left - sum(n for n in sizes if n in out)) / sum(n**1.5 for n in sizes if n not in out)
    while scale(certain) * math.sqrt(rest[0]) >= 1:
        certain.append(rest.pop(0))
    assert certain == [400]
    taken, chosen = [], Counter()
    for seed in range(10):
        got = mixing.mix(docs, weights=(1,), seed=f"s{seed}").collect()
        assert all(r.copies == 2 for r in got if r.size in certain) and {r.copies for r in got} <= {1, 2}
        taken.append(sum(r.copies * r.size for r in got))
        chosen.update(r.size for r in got if r.copies == 2)
        assert abs(taken[-1] - 1.5 * sum(sizes)) <= 5
    for n in (10, 1):
        want = scale(certain) * math.sqrt(n)
        assert abs(chosen[n] / 10 / sizes.count(n) - want) < 0.08


def test_mix_does_not_depend_on_partitions(spark):
    docs = sources(spark)
    once, again = (sorted(map(tuple, mixing.mix(docs.repartition(n)).collect()), key=str) for n in (1, 7))
    assert once == again
    other = sorted(map(tuple, mixing.mix(docs, seed="other").collect()), key=str)
    assert once != other


def test_repeated_documents(spark):
    docs = sources(spark).where("doc_id < 1000")
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    out = mixing.repeat_documents(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({i: n for i, n in copies.items() if n})
    assert mixing.mix(docs.limit(0)).count() == 0 == mixing.repeat_documents(docs.limit(0)).count()


# -- language model -------------------------------------------------------------------------


def plain_katz(rows, held):
    tokens = [[*(t or "").encode().lower().split(), "end"] for _, t in rows]
    learned = [t for t, (i, _) in zip(tokens, rows) if not held(i)]
    words, pairs = Counter(), Counter()
    for t in learned:
        words.update(t)
        pairs.update(zip(["start", *t], t))
    n, k = sum(words.values()), katz.MOST_DISCOUNTED
    d1, d2 = (katz.discounts(np.array([0] + [sum(c == r for c in x.values()) for r in range(1, k + 2)])) for x in (words, pairs))
    cut = lambda d, c: (d[c] if c <= k else 1.0) * c
    kept = sum(cut(d1, c) for c in words.values())
    whole = n if n - kept > 1e-9 else n + 1
    one = lambda w: cut(d1, words[w]) / whole if w in words else 1 - kept / whole
    after = defaultdict(list)
    for (h, w), c in pairs.items():
        after[h].append((w, c))
    wholes, alphas = {}, {}
    for h, seen in after.items():
        total, mass = sum(c for _, c in seen), sum(cut(d2, c) for _, c in seen)
        wholes[h] = total if total - mass > 1e-9 else total + 1
        alphas[h] = (1 - mass / wholes[h]) / (1 - sum(one(w) for w, _ in seen))

    def two(w, h):
        c = pairs.get((h, w), 0)
        return cut(d2, c) / wholes[h] if c else alphas.get(h, 1.0) * one(w)

    for h in ["start", "never", *list(after)[:40:7]]:
        assert abs(sum(two(w, h) for w in words) + two("unseen", h) - 1) < 1e-9
    base = lambda w: math.log10((words[w] + 1) / (n + len(words) + 1))
    return [
        (i, held(i), len(t), sum(w in words for w in t), n, sum(map(base, t)), sum(math.log10(two(w, h)) for w, h in zip(t, ["start", *t])))
        for t, (i, _) in zip(tokens, rows)
    ]


def fold(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def same_scores(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=str), sorted(want, key=str)):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-6)


def test_katz_query_agrees_with_brute_force(spark):
    rows = [tuple(r) for r in table(spark).select("doc_id", "text").collect()]
    same_scores(QUERIES["op5_katz"](spark, FOLDER).collect(), plain_katz(rows, fold))


def test_katz_does_not_depend_on_chunks_and_buckets(spark):
    docs = table(spark).repartition(3)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    same_scores(katz.score_documents(docs, chunk_tokens=2000, bucket_bytes=30000).collect(), plain_katz(rows, fold))


@pytest.mark.parametrize("texts", [["a a a a a a a", "a a a a a a a"], ["x y", "x z", "y"], ["one two three"] * 9, [""]])
def test_katz_of_thin_counts_is_normalised(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    from pyspark.sql import functions as F

    same_scores(katz.score_documents(frame, held=F.lit(False)).collect(), plain_katz(rows, lambda i: False))


def test_katz_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (4, "A a a"), (4, "A a a"), (6, "long " * 50000), (7, "É é  x")]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, chunk int, trained int")
    same_scores(katz.score_documents(frame).collect(), plain_katz(rows, fold))
    assert katz.score_documents(frame.limit(0)).count() == 0
    from pyspark.sql import functions as F

    alone = katz.score_documents(frame, held=F.lit(True)).collect()
    assert len(alone) == 7 and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in alone)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("katz")]


# -- search ---------------------------------------------------------------------------------


def plain_search(rows, is_query, k=10):
    words = [Counter((t or "").encode().lower().split()) for _, t in rows]
    length = [sum(c.values()) for c in words]
    mean, n = sum(length) / len(rows) or 1.0, len(rows)
    holds = Counter(w for c in words for w in c)
    out = []
    for (q, _), terms in zip(rows, words):
        if not is_query(q):
            continue
        scored = []
        for (i, _), c, m in zip(rows, words, length):
            s = sum(f * math.log1p((n - holds[w] + 0.5) / (holds[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * m / mean)) for w, f in terms.items() if w in c)
            if s > 0:
                scored.append((-round(s, 9), i is None, i))
        out += [(q, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:k])]
    return out


def same_hits(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=str), sorted(want, key=str)):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3], abs=1e-6)


def test_search_query_agrees_with_brute_force(spark):
    rows = [tuple(r) for r in table(spark).select("doc_id", "text").collect()]
    same_hits(QUERIES["op6_bm25"](spark, FOLDER).collect(), plain_search(rows, lambda i: i % 50 == 0))


def test_search_over_many_shards_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(bm25, "RANGE", 4)
    monkeypatch.setattr(bm25, "VISITED_FIRST", 1)
    monkeypatch.setattr(bm25, "VISITED", 2)
    monkeypatch.setattr(bm25, "GROUP_QUERIES", 3)
    monkeypatch.setattr(bm25, "SHARD_DOCUMENTS", 23)
    monkeypatch.setattr(bm25, "BUCKET_BYTES", 20000)
    docs = table(spark).repartition(3)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    same_hits(bm25.top_k(docs, docs["doc_id"] % 20 == 0, k=4).collect(), plain_search(rows, lambda i: i % 20 == 0, 4))


def test_pruning_leaves_ranges_out(spark, monkeypatch):
    """Once the best document is known, a range is skipped if its bound is below."""
    texts = ["rare common"] + ["common filler"] * 900
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    shard = bm25.Shard(bm25._index_rows(frame, "bigint").first().asDict(), 2.0)
    visited = []
    plain = bm25.Shard._scored
    monkeypatch.setattr(bm25, "VISITED_FIRST", 1)
    monkeypatch.setattr(bm25, "VISITED", 2)
    monkeypatch.setattr(bm25.Shard, "_scored", lambda self, ranges, *rest: visited.extend(ranges) or plain(self, ranges, *rest))
    terms = katz.word_numbers([b"rare", b"common"])
    best = shard.search(terms, np.array([5.0, 0.1]), 1, [])
    assert [b[2] for b in best] == [0] and visited == [0]
    best = shard.search(terms[1:], np.array([0.1]), 3, [])
    assert [b[2] for b in best] == [0, 1, 2] and sorted(visited[1:]) == list(range(15))
    assert shard.search(terms, np.array([5.0, 0.1]), 1, [(-100.0, (False, 7), 7)]) == [(-100.0, (False, 7), 7)]


def test_search_odd_rows(spark):
    rows = [(50, None), (100, "a b"), (None, "a b"), (4, "a a a"), (4, "a a a"), (0, "zz"), (150, ""), (200, "A long " + "b " * 40000)]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, shard int, terms string")
    same_hits(bm25.top_k(frame, frame["doc_id"] % 50 == 0, k=3).collect(), plain_search(rows, lambda i: i is not None and i % 50 == 0, 3))
    assert bm25.top_k(frame.limit(0), frame["doc_id"] % 50 == 0).count() == 0


def test_repeated_queries_and_ties_in_one_shard(spark):
    rows = [(50, "a b"), (50, "a b"), (50, "c"), (1, "a c"), *[(i, "c d d") for i in range(60, 90)]]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(map(tuple, bm25.top_k(frame, frame["doc_id"] == 50, k=4).select("query_id", "rank", "doc_id").collect()))
    assert got == sorted([(50, 1, 50), (50, 2, 50), (50, 3, 1), (50, 1, 50), (50, 2, 1), (50, 3, 60), (50, 4, 61)])


def test_search_by_products_of_matrices(spark, monkeypatch):
    """Many queries at once: small blocks, shards and rounds, ties beyond k in a shard and across shards, few tasks' rows."""
    rng = random.Random(7)
    common, rare = [f"c{i}" for i in range(30)], [f"r{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(common, k=rng.randint(0, 40)) + rng.choices(rare, k=rng.randint(0, 6))) for _ in range(700)]
    texts += ["c1 c2 r5 r5"] * 60 + ["c1 c2 r5 r5 " + w for w in rare[:60]] + ["", "é É c1", None, "c3 " * 3000]
    rows = [(i if i % 37 else None, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    for name, value in {"SHARD_DOCUMENTS": 40, "BLOCK_QUERIES": 24, "BLOCK_DOCUMENTS": 16, "POSTINGS": 64, "CROWD": 2, "FINAL_PAIRS": 300, "GROUP_QUERIES": 150, "SAMPLE": 3}.items():
        monkeypatch.setattr(bm25, name, value)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for k in (1, 4):
        same_hits(bm25.top_k(frame, frame["doc_id"] % 3 == 0, k=k).collect(), plain_search(rows, lambda i: i is not None and i % 3 == 0, k))


def test_groups_of_queries_are_filled_across_partitions(spark, monkeypatch):
    """Each group reads the whole index, so queries that lie in many partitions still make one group."""
    groups = []
    plain = bm25._best_of_tasks
    monkeypatch.setattr(bm25, "_best_of_tasks", lambda index, ids, *rest: groups.append(len(ids)) or plain(index, ids, *rest))
    frame = spark.createDataFrame([(i, f"a{i} b c") for i in range(300)], "doc_id long, text string").repartition(20)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert bm25.top_k(frame, frame["doc_id"] % 2 == 0, k=2).count() == 300
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert groups == [150]


@pytest.mark.parametrize("most", (1 << 15, 64, 1))
def test_blocks_and_crowds_of_a_shard(spark, monkeypatch, most):
    """Blocks of any size find the same; of many ties the ids decide before the final scores."""
    monkeypatch.setattr(bm25, "BLOCK_QUERIES", 5)
    monkeypatch.setattr(bm25, "BLOCK_DOCUMENTS", 37)
    monkeypatch.setattr(bm25, "POSTINGS", most)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, weights=range(60, 0, -1), k=rng.randint(0, 30))) for _ in range(200)] + ["w1 w2 w59"] * 90
    frame = spark.createDataFrame([(-i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    shard = bm25.Shard(bm25._index_rows(frame, "bigint").first().asDict(), 15.0)
    asked = [np.unique(katz.word_numbers(t.encode().split())) for t in texts[:17] + ["w1 w2 w59", "nowhere", ""]]
    terms = np.unique(np.concatenate(asked))
    queries = bm25.Queries(terms, np.linspace(0.5, 4, len(terms)), np.array([len(a) for a in asked]), np.searchsorted(terms, np.concatenate(asked)).astype(np.int32), np.ones(sum(map(len, asked)), np.int32))
    number, place, _ = shard.likely(queries, 6, np.full(20, float(np.finfo(np.float32).tiny)))
    for q in range(20):
        codes, weights = queries.of(q)
        want = [x[2] for x in shard.search(terms[codes], weights, 6, [])]
        mine = place[number == q]
        assert set(want) <= {shard.doc_ids[p] for p in mine} and len(mine) <= 4 * 6
    assert [len(place[number == q]) for q in (17, 18, 19)] == [6, 0, 0]


def test_a_floor_known_before_leaves_few_documents_of_a_task(spark):
    """What tasks send for a query follows the documents above its floor, not the number of tasks."""
    rng = random.Random(3)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 30))) for _ in range(2000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    shard = bm25.Shard(bm25._index_rows(frame, "bigint").first().asDict(), 15.0)
    terms = np.unique(katz.word_numbers([c.encode() for c in "abcdefgh"]))
    queries = bm25.Queries(terms, np.ones(8), np.array([8, 3]), np.array([*range(8), 0, 1, 2], np.int32), np.ones(11, np.int32))
    exact = [total for _, _, total, _ in shard.exact(queries, np.repeat([0, 1], 2000), np.tile(np.arange(2000), 2))]
    floor = np.array([np.sort(t)[-3] for t in exact]) * (1 - queries.slack)
    number, place, score = shard.likely(queries, 10, floor)
    for q in range(2):
        mine = place[number == q]
        assert set(np.argsort(-exact[q], kind="stable")[:3]) <= set(mine) and len(mine) < 10
        assert np.all(np.abs(score[number == q] / exact[q][mine] - 1) < queries.slack[q] / 2)


@pytest.mark.parametrize("kind", ("smallint", "decimal(9,0)", "date"))
def test_ids_of_other_types(spark, kind):
    from pyspark.sql import functions as F

    number = F.expr("date_add(date'2024-01-01', doc_id)") if kind == "date" else F.col("doc_id").cast(kind)
    frame = spark.createDataFrame([(50, "a b"), (1, "a c")], "doc_id int, text string").withColumn("doc_id", number)
    assert katz.score_documents(frame).dtypes[0] == ("doc_id", kind) and katz.score_documents(frame).count() == 2
    got = bm25.top_k(frame, F.lit(True), k=1)
    assert got.dtypes[0] == ("query_id", kind) and all(r.query_id == r.doc_id for r in got.collect())


def test_repeated_documents_keep_columns_of_any_name(spark):
    frame = spark.createDataFrame([(i, "a b c", "s", i, "x") for i in range(5)], "doc_id long, text string, source string, mixed_copies int, Mixed_ID string")
    assert mixing.repeat_documents(frame).columns == frame.columns
    assert {r.mixed_copies for r in mixing.repeat_documents(frame).collect()} <= set(range(5))


# -- pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = table(spark)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "secret_scan", "source_mix", "bpe"]
    columns, frames = docs.columns, [docs]
    from tidemark.workspace import freeze

    for name, stage in corpus_pipeline.STAGES:
        frames.append(freeze(stage(spark, frames[-1], FOLDER), f"test-{name}"))
    raw, labelled, single, masked, mixed, coded = frames
    assert all(f.columns == columns for f in frames[:-1])
    assert labelled.count() == raw.where("text rlike '[a-zA-Z]'").count()
    assert {r.doc_id for r in single.collect()} == plain_kept([tuple(r) for r in labelled.select("doc_id", "text").orderBy("doc_id").collect()])
    from tidemark.llm import secrets

    before, after = (dict(f.select("doc_id", "text").collect()) for f in (single, masked))
    assert after == {i: secrets.redact(t) for i, t in before.items()} and before != after
    copies = {r.doc_id: r.copies for r in mixing.mix(masked).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in copies.items() if n})
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = coded.collect()
    assert all(r.ids == plain.encode(after[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids) for r in rows)
    assert all(r.decoded_sha256 == hashlib.sha256((after[r.doc_id] or "").encode()).hexdigest() for r in rows)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in mixed.collect())
    assert driver.queries()["pipeline"](spark, FOLDER).count() == len(rows)


def test_pipeline_of_nothing(spark):
    docs = table(spark).limit(0)
    from tidemark.workspace import freeze

    for name, stage in corpus_pipeline.STAGES:
        docs = freeze(stage(spark, docs, FOLDER), f"test-{name}")
    assert docs.count() == 0
