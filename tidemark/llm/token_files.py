"""Token id files: each document compressed by itself with a dictionary all share.

A folder holds ``dictionary`` (one row: its SHA-256 and its bytes) and ``blocks``, a table of
blocks of documents in ascending order of their ids over parts and blocks:

    part, block        place of the block
    first_id, last_id  ids of its first and last document
    before, total      token ids in the part's earlier blocks, and in this one
    dictionary         SHA-256 of the dictionary that its frames need
    doc_ids, n_tokens  ids and lengths of its documents
    offsets            where each document's frame begins in ``frames``, and the end
    frames             zstandard frames, one per document, of little-endian unsigned 32-bit ids

so that one short document is found by the ids of the blocks and read by its offsets alone.
"""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.batches import arrow_type, id_and_text, slices, texts
from tidemark.llm.bpe import COMMON, tokenizer_content
from tidemark.llm.wordcache import WordCache

#: The dictionary is trained on at most so many pieces, of so many bytes, of so many documents; it changes sizes, not results.
SAMPLE_DOCUMENTS, PIECES, PIECE_BYTES, DICTIONARY_BYTES = 1000, 4, 4 << 10, 64 << 10
LEVEL, BLOCK_DOCUMENTS, BLOCK_BYTES = 3, 1024, 1 << 20
CACHED_WORDS, CACHED_CHARS, WORDS_IN_CALL = 500_000, 16 << 20, 256


@lru_cache(1)
def encoder(content: bytes) -> WordCache:
    """The library's ids, word by word.

    The tokenizer drops white space and no token spans it, so the words between blanks and line
    feeds can be encoded by themselves, each once.
    """
    # a task has one core; idle threads of the library would only spin
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library = Tokenizer.from_str(content.decode())
    library.no_truncation()
    library.no_padding()
    return WordCache(_split, partial(_learn, library), CACHED_WORDS, CACHED_CHARS)


def _split(text: str) -> list[str]:
    """Capitals of plain texts are lowered here already: the tokenizer does so, and fewer words differ."""
    if (text.isascii() or COMMON.issuperset(text)) and "<|" not in text:
        text = text.lower()
    return text.replace("\n", " ").split(" ")


def _learn(library: Tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of the words, and where each word's start and how many they are.

    Many words go in one call, a special token between them: the library cuts a text there
    before anything else, and its id shows where the words' ids end.
    """
    special = {token.content: i for i, token in library.get_added_tokens_decoder().items() if not (token.normalized or token.lstrip or token.rstrip or token.single_word)}
    between, end = next(iter(special.items()), ("", -1))
    together = "\n".join(words)
    if between and not any(s in together for s in special):
        alone, plain = [False] * len(words), words
    else:
        alone = [not between or any(s in w for s in special) for w in words]
        plain = [w for w, x in zip(words, alone) if not x]
    joined = [between.join(plain[i : i + WORDS_IN_CALL]) + between for i in range(0, len(plain), WORDS_IN_CALL)]
    flat = np.array([i for e in library.encode_batch(joined, add_special_tokens=False) for i in e.ids], np.int32)
    ends = np.flatnonzero(flat == end)
    if len(ends) != len(plain):
        raise ValueError("words and their ids do not match")
    made = [e.ids for e in library.encode_batch([w for w, x in zip(words, alone) if x], add_special_tokens=False)]
    starts, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    is_alone = np.array(alone, bool)
    starts[~is_alone] = np.append(0, ends[:-1] + 1)[: len(plain)]
    counts[~is_alone] = ends - starts[~is_alone]
    counts[is_alone] = [len(ids) for ids in made]
    starts[is_alone] = len(flat) + np.cumsum(counts[is_alone]) - counts[is_alone]
    return np.concatenate([flat, *[np.array(ids, np.int32) for ids in made]]), starts, counts


def _documents(batches, content: bytes, end_id: int):
    """``(id, little-endian ids with the end id)`` of each row."""
    for batch in slices(batches, "text"):
        ids, offsets = encoder(content).encode(texts(batch.column("text")))
        ids = ids.astype("<u4")
        for i, key in enumerate(batch.column("doc_id").to_pylist()):
            yield key, ids[offsets[i] : offsets[i + 1]].tobytes() + end_id.to_bytes(4, "little")


def sample_pieces(key: str, data: bytes) -> list[bytes]:
    """At most ``PIECES`` pieces of the ids, at places that depend on the document's id."""
    places = range(0, len(data), PIECE_BYTES)
    chosen = sorted(places, key=lambda at: xxhash.xxh64_intdigest(f"{key}:{at}"))[:PIECES]
    return [data[at : at + PIECE_BYTES] for at in sorted(chosen)]


def train_dictionary(docs: DataFrame, content: bytes, end_id: int) -> bytes:
    """Trained in one task on a fixed number of documents, those whose hashed ids are smallest.

    Of a long one, pieces from anywhere in it are taken. Empty if they are too few to train on.
    """
    chosen = docs.select(F.col("doc_id").alias("chosen_id")).orderBy(F.xxhash64("chosen_id"), "chosen_id").limit(SAMPLE_DOCUMENTS)
    # SAMPLE_DOCUMENTS ids at most
    sample = docs.join(F.broadcast(chosen.distinct()), F.col("doc_id").eqNullSafe(F.col("chosen_id")), "left_semi")

    def cut(batches):
        for key, data in _documents(batches, content, end_id):
            yield pa.RecordBatch.from_arrays([pa.array(sample_pieces(str(key), data), pa.binary())], ["data"])

    def train(batches):
        samples = sorted(x for batch in batches for x in batch.column("data").to_pylist())[: SAMPLE_DOCUMENTS * PIECES]
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:
            made = b""
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["data"])

    row = sample.mapInArrow(cut, "data binary").repartition(1).mapInArrow(train, "data binary").first()
    return bytes(row["data"]) if row else b""


def _zstd_dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode the texts and write them to the new folder ``path``.

    Null and empty texts have the end id alone. Rows are in ascending order of the id, null
    first; those repeated under one id are each written, in any order. An empty table writes
    no blocks. Other columns are left behind.
    """
    spark = docs.sparkSession
    content = tokenizer_content(tokenizer_path)
    narrow = id_and_text(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    trained = train_dictionary(narrow, content, end_id)
    name = hashlib.sha256(trained).hexdigest()
    spark.createDataFrame([(name, trained)], "dictionary string, data binary").write.parquet(f"{path}/dictionary")

    def pack(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zstd_dictionary(trained))
        part, block, before, held = TaskContext.get().partitionId(), 0, 0, []
        held_bytes = 0
        for key, data in _documents(batches, content, end_id):
            held.append((key, len(data) // 4, compressor.compress(data)))
            held_bytes += len(held[-1][2])
            if len(held) == BLOCK_DOCUMENTS or held_bytes >= BLOCK_BYTES:
                yield packed(part, block, before, held)
                block, before, held, held_bytes = block + 1, before + sum(n for _, n, _ in held), [], 0
        if held:
            yield packed(part, block, before, held)

    def packed(part, block, before, held):
        keys, sizes, frames = zip(*held)
        offsets = np.append(0, np.cumsum([len(f) for f in frames])).tolist()
        row = [part, block, keys[0], keys[-1], before, sum(sizes), name, keys, sizes, offsets, b"".join(frames)]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names)

    key, longs = arrow_type(kind), pa.list_(pa.int64())
    types = [pa.int32(), pa.int32(), key, key, pa.int64(), pa.int64(), pa.string(), pa.list_(key), longs, longs, pa.binary()]
    names = ["part", "block", "first_id", "last_id", "before", "total", "dictionary", "doc_ids", "n_tokens", "offsets", "frames"]
    schema = (
        f"part int, block int, first_id {kind}, last_id {kind}, before long, total long, dictionary string,"
        f" doc_ids array<{kind}>, n_tokens array<long>, offsets array<long>, frames binary"
    )
    ordered = narrow.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    ordered.mapInArrow(pack, schema).write.parquet(f"{path}/blocks")


def _dictionaries(spark: SparkSession, path: str) -> dict[str, bytes]:
    return {r["dictionary"]: bytes(r["data"]) for r in spark.read.parquet(f"{path}/dictionary").collect()}


def _decompressor(dictionaries: dict[str, bytes], name: str) -> zstandard.ZstdDecompressor:
    data = dictionaries.get(name)
    if data is None or hashlib.sha256(data).hexdigest() != name:
        raise ValueError(f"the dictionary {name} is missing or damaged")
    return zstandard.ZstdDecompressor(dict_data=_zstd_dictionary(data))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``data`` of every document.

    ``start`` counts the ids of the documents before it; ``data`` holds its ids as little-endian
    unsigned 32-bit integers. Blocks know what precedes them in their part, so only the parts
    are summed up and broadcast: one row for each task of the writing job.
    """
    dictionaries = _dictionaries(spark, path)
    stored = spark.read.parquet(f"{path}/blocks")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        stored.groupBy("part").agg(F.sum("total").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    )
    kind = stored.schema["first_id"].dataType.simpleString()
    key = arrow_type(kind)

    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                reader = _decompressor(dictionaries, row["dictionary"])
                frames, offsets, sizes = row["frames"], row["offsets"], row["n_tokens"]
                data = [reader.decompress(frames[a:b]) for a, b in zip(offsets, offsets[1:])]
                begins = row["before"] + np.cumsum([0, *sizes[:-1]])
                columns = [pa.array(row["doc_ids"], key), pa.array([row["part"]] * len(sizes), pa.int32()), pa.array(begins), pa.array(sizes), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "before", "n_tokens", "data"])

    documents = stored.select("part", "before", "dictionary", "doc_ids", "n_tokens", "offsets", "frames").mapInArrow(
        unpack, f"doc_id {kind}, part int, before long, n_tokens long, data binary"
    )
    return documents.join(F.broadcast(parts), "part").select("doc_id", (F.col("part_start") + F.col("before")).alias("start"), "n_tokens", "data")


def read_document(spark: SparkSession, path: str, doc_id) -> list[list[int]]:
    """The ids of the documents with this id: only blocks that may hold it are read, only their frames decompressed."""
    dictionaries = _dictionaries(spark, path)
    near = spark.read.parquet(f"{path}/blocks").where(
        (F.col("first_id").isNull() | (F.col("first_id") <= doc_id)) & (F.col("last_id") >= doc_id)
    )
    placed = near.select("dictionary", "frames", "offsets", F.posexplode("doc_ids").alias("place", "key")).where(F.col("key") == doc_id)
    begin, end = F.element_at("offsets", F.col("place") + 1), F.element_at("offsets", F.col("place") + 2)
    frame = F.substring(F.col("frames"), (begin + 1).cast("int"), (end - begin).cast("int")).alias("frame")
    found = placed.select("dictionary", frame).collect()
    return [np.frombuffer(_decompressor(dictionaries, r["dictionary"]).decompress(bytes(r["frame"])), "<u4").tolist() for r in found]


def digest(documents: DataFrame) -> DataFrame:
    """The CRC-32 of the ids' bytes instead of the ids."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("data").alias("ids_crc32"))
