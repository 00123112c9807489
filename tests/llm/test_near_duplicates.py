"""SimHash groups, lattice links and the components both rest on, against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import lattice, simhash
from tidemark.llm.graph import connected_components, local_roots
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain_roots(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, x) for x in range(101, 160)]
    pairs = chain + star + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    want = plain_roots(300, pairs)
    edges = spark.createDataFrame(pairs + [(7, 7)] + [(None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {x: want[x] for a, b in pairs if a != b for x in (a, b)}
    a, b = np.array(pairs).T
    assert local_roots(300, a, b).tolist() == want


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if w]
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query_agrees_with_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    ids = sorted(prints)
    pairs = [(i, j) for i in range(len(ids)) for j in range(i) if (prints[ids[i]] ^ prints[ids[j]]).bit_count() <= 3]
    root = plain_roots(len(ids), pairs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash"](spark, FOLDER).collect()}
    assert got == {d: (f"{prints[d]:016x}", ids[root[i]]) for i, d in enumerate(ids)}
    assert len({c for _, c in got.values()}) < len(ids)


def test_simhash_links_exactly_up_to_the_radius(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = {b ^ sum(1 << bit for bit in rng.sample(range(64), k)) for b in base for k in (0, 1, 3, 4, 6)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    pairs = [(i, j) for i in range(len(signed)) for j in range(i) if (signed[i] ^ signed[j]) & (2**64 - 1) and ((signed[i] ^ signed[j]) & (2**64 - 1)).bit_count() <= 3]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = [(signed.index(r.a), signed.index(r.b)) for r in simhash.links(frame).collect()]
    assert plain_roots(len(signed), edges) == plain_roots(len(signed), pairs)


HAND = [
    (1, None), (2, ""), (3, " \n\t "), (5, "One two"), (6, "ONE\ttwo"), (7, "one two three"), (7, "one two three"),
    (None, "one two three"), (9, "long " * 30000), (10, "café Été x"), (11, "café été x"),
]


def test_simhash_of_odd_rows(spark):
    frame = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in HAND], "doc_id long, text string, fp int, component int, tile int")
    got = simhash.near_duplicates(frame).collect()
    assert len(got) == len(HAND)
    of = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {of[i].component_id for i in (1, 2, 3)} == {1} and of[1].fingerprint == "0" * 16
    assert of[6].component_id == 5
    assert [r.component_id for r in got if r.doc_id in (7, None)] == [7, 7, 7]
    assert all(r.fingerprint == f"{plain_fingerprint(dict(HAND)[r.doc_id]):016x}" for r in got)
    assert of[10].fingerprint != of[11].fingerprint
    kept = simhash.keep_one_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 5, 7, 9, 10, 11, None], key=str)
    assert simhash.near_duplicates(frame.limit(0)).count() == 0
    assert simhash.keep_one_each(frame.limit(0)).count() == 0


def test_e8_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((500, 8)) * 3
    near, around = lattice.e8_decode(x), lattice.e8_neighbours()
    assert around.shape == (240, 8) and np.allclose((around**2).sum(axis=1), 2)
    doubled = 2 * near
    assert np.allclose(doubled, np.rint(doubled)) and np.all(np.rint(doubled).astype(int) % 2 == np.rint(doubled[:, :1]).astype(int) % 2)
    assert np.all(near.sum(axis=1) % 2 == 0)
    own = ((x - near) ** 2).sum(axis=1)
    assert all(np.all(own <= ((x - near - v) ** 2).sum(axis=1) + 1e-9) for v in around)


def plain_links(rows, threshold=0.98):
    """Links of (id, vector, label) rows as pairs of positions."""

    def fine(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    pairs = []
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows[:i]):
            if a == b and fine(v, a) and fine(w, b) and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    pairs.append((i, j))
    return pairs


def planted_vectors(seed, n=160, size=24):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        base = np.random.default_rng([seed, rng.integers(25)]).standard_normal(size)
        noise = rng.choice([0.0, 0.02, 0.08, 0.2])
        rows.append((i, (base + noise * rng.standard_normal(size)).astype(np.float32).tolist(), int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("seed", (1, 2))
def test_lattice_recall_on_planted_vectors(spark, seed):
    rows = planted_vectors(seed)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in lattice.near_duplicates(frame).collect()}
    n = np.zeros(len(rows), int)
    for i, j in (pairs := plain_links(rows)):
        n[i] += 1
        n[j] += 1
    found = np.array([got[i].n_links for i in range(len(rows))])
    assert np.all(found <= n) and found.sum() >= 0.97 * n.sum() and len(pairs) > 50
    root = plain_roots(len(rows), pairs)
    assert sum(got[i].component_id == root[i] for i in range(len(rows))) >= 0.97 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_lattice_query_agrees_with_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op1_lattice"](spark, FOLDER).collect()}
    pairs = plain_links(rows)
    root = plain_roots(len(rows), pairs)
    assert got == {rows[i][0]: (sum(i in p for p in pairs), rows[root[i]][0]) for i in range(len(rows))}


def test_lattice_tiles_give_the_same(spark, monkeypatch):
    rows = planted_vectors(7, n=90)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    whole = sorted(map(tuple, lattice.near_duplicates(frame).collect()))
    monkeypatch.setattr(lattice, "TILE", 3)
    assert sorted(map(tuple, lattice.near_duplicates(frame).collect())) == whole


def test_lattice_odd_rows(spark):
    one, nan, inf = [1.0, 0.0, 0.0], float("nan"), float("inf")
    rows = [
        (1, one, 1), (2, one, 1), (3, [2.0, 0.0, 0.0], 1), (4, one, 2), (5, one, None), (6, None, 1), (7, [0.0] * 3, 1), (8, [nan, 1.0, 0.0], 1),
        (9, [inf, 0.0, 0.0], 1), (10, [None, 1.0, 0.0], 1), (11, [], 1), (12, [1.0, 0.0], 1), (13, [1e-30, 0.0, 0.0], 1), (None, one, 1), (2, one, 1),
        (14, [-1.0, 0.0, 0.0], 1),
    ]
    frame = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, embedding array<float>, label int, cells string, node int")
    got = lattice.near_duplicates(frame)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    rows = sorted(map(tuple, got.collect()), key=str)
    assert len(rows) == 16
    linked = [r for r in rows if r[1]]
    assert sorted((r[0] for r in linked), key=str) == sorted([1, 2, 2, 3, 13, None], key=str)
    assert {r[1:3] for r in linked} == {(5, 1)}
    assert all(r[2] == r[0] and r[3] for r in rows if not r[1])
    assert lattice.near_duplicates(frame.limit(0)).count() == 0


def plain_kept(rows):
    """The smallest ids of the groups of (id, text) rows whose fingerprints differ in three bits or fewer."""
    prints = [plain_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    return {rows[x][0] for x in plain_roots(len(rows), pairs)}


def planted_texts(seed):
    """Texts of 64 to 250 words, each with copies in which more and more words are changed."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for _ in range(40):
        base = [word() for _ in range(rng.randint(64, 250))]
        texts += [base, list(base)]
        for share in (0.004, 0.01, 0.02, 0.05):
            near = list(base)
            for at in sorted(rng.sample(range(len(base)), max(1, round(share * len(base)))), reverse=True):
                near[at : at + 1] = rng.choice([[word()], [], [near[at], word()]])
            texts.append(near)
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_stage_keeps_one_of_each_group(spark):
    rows = planted_texts(1)
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " \n", "a b c", "A  b c", "a b c d x"])]
    want = plain_kept(rows)
    assert 40 <= len(want) < len(rows) - 40
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, frame, FOLDER).collect()} == want
    assert corpus_pipeline.near_duplicates(spark, frame.limit(0), FOLDER).count() == 0


def test_stage_keeps_columns_of_any_name(spark):
    rows = [(1, "a b c d", 7, "x"), (2, "A b c d", 8, "y"), (3, "other words", 9, None), (3, "other words", 9, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept_n int, Kept_Id string")
    kept = simhash.keep_one_each(frame)
    assert kept.columns == frame.columns and sorted(map(tuple, kept.collect()), key=str) == [rows[0], rows[2]]


def test_stage_agrees_with_brute_force_on_the_table(spark):
    docs = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()} == plain_kept(rows)
