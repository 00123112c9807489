"""Byte pair encoding, token files and their readers against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, token_files
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")

HARD = [
    "", "a", " ", "  ", "a" * 4000, " \n\n  x y \t", "<|endoftext|>a<|endoftext|>", "<|endoftext|", "՘࢏ abc", "日本語" * 40,
    "\x1c\x1d a\x85b​ c", "it's we'LL 'tis I'd", "\U0001f600" * 20, "ab" * 2000, "½ ²x ªµº ×÷ ‘a’ €5", "\x00\x01",
    "İstanbul ΣΑΣ straße é ́x", "it 's don't a b\r\n",
]


def library(path):
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def random_texts(seed, n=150):
    rng = random.Random(seed)
    pools = [range(32, 127), range(0x80, 0x3000), range(0xA1, 0x250), (32, 10, 9), range(0x10000, 0x1FFFF)]
    return ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_encoding_agrees_with_the_library(spark):
    texts = HARD + random_texts(1)
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    coded = bpe.encode(frame, BYTES)
    assert set(coded.columns) == {"doc_id", "text", "ids"}
    got = {r.doc_id: r for r in bpe.decode(coded, BYTES).collect()}
    plain = library(BYTES)
    for i, t in enumerate(texts):
        want = plain.encode(t, add_special_tokens=False).ids
        assert got[i].ids == want, t[:40]
        assert got[i].decoded == plain.decode(want, skip_special_tokens=False) == t


def test_round_trip_is_encoding_and_decoding(spark):
    texts = [*HARD, *random_texts(2), None]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, decoded string")
    both = bpe.round_trip(frame, BYTES)
    assert both.columns == ["doc_id", "ids", "decoded"]
    apart = bpe.decode(bpe.encode(frame, BYTES), BYTES).drop("text")
    assert sorted(map(str, both.collect())) == sorted(map(str, apart.select(*both.columns).collect()))
    assert bpe.round_trip(frame.limit(0), BYTES).count() == 0


def test_encoding_odd_rows(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (None, "two two"), (3, "")], "doc_id long, text string")
    rows = sorted((str(r.doc_id), r.ids, r.decoded) for r in bpe.decode(bpe.encode(frame, BYTES), BYTES).collect())
    assert rows == [("1", [], ""), ("1", [], ""), ("3", [], ""), ("None", library(BYTES).encode("two two").ids, "two two")]
    assert bpe.encode(frame.limit(0), BYTES).count() == 0
    strange = spark.createDataFrame([([999999, -1, 64],), (None,), ([222],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(strange, BYTES).collect()] == ["a", "", "�"]


def test_word_cache_may_be_dropped_at_any_time():
    from tidemark.llm.wordcache import WordCache

    vocab = bpe.vocabulary(bpe.tokenizer_content(BYTES))
    cache = WordCache(vocab.split, lambda words: bpe.learn_words(vocab, words), 3, 20)
    plain = library(BYTES)
    for text in random_texts(2, 40) + ["same words same words"] * 3:
        ids, offsets = cache.encode([text, "", text])
        want = plain.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want * 2 and offsets.tolist() == [0, len(want), len(want), 2 * len(want)]


def test_bpe_query_agrees_with_the_library(spark):
    plain = library(BYTES)
    for r in QUERIES["op3_bpe"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet"), "doc_id").collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(plain.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_token_files_query_agrees_with_the_library(spark):
    plain, start = library(WORDS), 0
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in QUERIES["op4_token_files"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = [*plain.encode(d.text or "", add_special_tokens=False).ids, 2]
        r = got[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.parametrize("block", (1024, 2))
def test_token_files_odd_rows(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK_DOCUMENTS", block)
    rows = [(5, None), (1, ""), (7, "seven"), (7, "seven"), (None, "x"), *[(20 + i, t) for i, t in enumerate(HARD)]]
    frame = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, part int").repartition(3)
    path = str(tmp_path / "files")
    token_files.write_token_files(frame, path, WORDS, 2)
    plain, start = library(WORDS), 0
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 5, 7, 7, *range(20, 20 + len(HARD))]
    for r in got:
        want = [*plain.encode(dict(rows)[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert np.frombuffer(bytes(r.data), "<u4").tolist() == want and (r.start, r.n_tokens) == (start, len(want))
        start += len(want)
    assert token_files.read_document(spark, path, 7) == [[*plain.encode("seven", add_special_tokens=False).ids, 2]] * 2
    assert token_files.read_document(spark, path, 6) == []


def test_token_files_of_nothing(spark, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), path, WORDS, 2)
    assert token_files.read_token_files(spark, path).count() == 0


def test_a_wrong_dictionary_is_noticed(spark, tmp_path):
    path = str(tmp_path / "files")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    token_files.write_token_files(docs, path, WORDS, 2)
    stored = spark.read.parquet(f"{path}/dictionary").first()
    assert len(stored["data"]) > 1000 and hashlib.sha256(bytes(stored["data"])).hexdigest() == stored["dictionary"]
    spark.createDataFrame([(stored["dictionary"], b"other")], "dictionary string, data binary").write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(Exception, match="missing or damaged"):
        token_files.read_token_files(spark, path).agg(F.sum("n_tokens")).collect()


def test_dictionary_samples_come_from_anywhere_in_a_text():
    data = bytes(range(256)) * 4000
    pieces = token_files.sample_pieces("7", data)
    assert len(pieces) == token_files.PIECES and all(len(p) == token_files.PIECE_BYTES for p in pieces)
    starts = {place for key in "abcdefgh" for place in _places(key, len(data))}
    assert max(starts) > len(data) // 2 and len(starts) > token_files.PIECES
    assert token_files.sample_pieces("7", b"short") == [b"short"] and token_files.sample_pieces("7", b"") == []


def _places(key, size):
    marked = b"".join(at.to_bytes(4, "little") * (token_files.PIECE_BYTES // 4) for at in range(0, size, token_files.PIECE_BYTES))
    return [int.from_bytes(p[:4], "little") for p in token_files.sample_pieces(key, marked)]


def test_ids_of_any_whole_type(spark, tmp_path):
    frame = spark.createDataFrame([(3, "b c"), (1, "a")], "doc_id int, text string")
    for kind in ("smallint", "bigint", "string", "decimal(9,0)"):
        path = str(tmp_path / kind.split("(")[0])
        token_files.write_token_files(frame.withColumn("doc_id", frame["doc_id"].cast(kind)), path, WORDS, 2)
        read = token_files.digest(token_files.read_token_files(spark, path))
        assert dict(read.dtypes)["doc_id"] == kind and sorted(int(r.doc_id) for r in read.collect()) == [1, 3]
