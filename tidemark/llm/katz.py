"""A Katz back-off bigram model of a corpus, and the log probability of every text under it.

    P(w | h) = d(c) c / D(h)             if the pair was seen c > 0 times in training
             = alpha(h) P(w)             otherwise, where
    P(w)     = d1(c) c / N' if the word was seen, else the mass left for unseen words.

d are Good-Turing discounts for counts up to five. D(h) is the number of tokens after h, one
more if discounting leaves nothing to back off with; alpha(h) is exactly what makes the
probabilities after h add up to one. Words before the first and after the last are a start
symbol, which is only ever a history, and the end token.

The text is read once, into chunks of about 800,000 tokens: which words each holds, how often,
and its tokens as numbers into that list. From then on only what is distinct in a chunk travels:

1. word counts to buckets by word, and back: each word's number and count;
2. pair counts to buckets by pair, and back: each pair's count. A bucket also sums up, for each
   history, what its pairs take from the whole;
3. these sums to buckets by history, and back: D and alpha;

after which a chunk can score its tokens. A word or pair of any frequency travels once for each
chunk. Chunks are stored as a table bucketed by chunk, so the tokens stay where they are.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.batches import arrow_type, in_fold, slices, text_bytes
from tidemark.workspace import delete_folder, freeze, scratch_path

#: Counts up to this are discounted.
MOST_DISCOUNTED = 5
CHUNK_TOKENS = 3 << 18
#: Bytes of text for each bucket.
BUCKET_BYTES = 4 << 20
#: No word holds white space, so these can stand for the start and the end.
START, END = b" ", b"\n"
START_ID = 0


def word_numbers(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(7)), np.uint64, len(words))


def _packed(x: np.ndarray) -> bytes:
    """All first bytes, then all second bytes and so on: most numbers are small, so most planes are zero."""
    planes = np.ascontiguousarray(x).reshape(-1).view(np.uint8).reshape(-1, x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes))


def _unpacked(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).reshape(-1).view(kind)


def _packed_rising(x: np.ndarray) -> bytes:
    return _packed(np.diff(x, prepend=x.dtype.type(0)))


def _unpacked_rising(data: bytes, kind) -> np.ndarray:
    return np.cumsum(_unpacked(data, kind), dtype=kind)


def discounts(of_count: np.ndarray) -> np.ndarray:
    """``d[r]`` for r = 0..5 from ``of_count[r]``, the number of kinds seen r times (r = 1..6).

    Good-Turing discounts, renormalised so that the mass they free is that of kinds seen once.
    Where counts of counts are too thin or uneven for that (a discount not in (0, 1]), absolute
    discounting by n1 / (n1 + 2 n2) is used instead, by a half if n1 or n2 is zero.
    """
    k = MOST_DISCOUNTED
    n = of_count.astype(np.float64)
    d = np.ones(k + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        common = (k + 1) * n[k + 1] / n[1]
        turing = np.array([((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) for r in range(1, k + 1)])
    if np.all(np.isfinite(turing) & (turing > 0) & (turing <= 1)) and turing[0] < 1:
        d[1:] = turing
    else:
        cut = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        d[1:] = [(r - cut) / r for r in range(1, k + 1)]
    return d


@dataclass
class Level:
    """Totals of one order of n-grams: tokens, kinds, and how many kinds have each small count."""

    tokens: int
    kinds: int
    of_count: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> list[int]:
        seen = counts[counts > 0]
        return [int(seen.sum()), len(seen), *np.bincount(np.minimum(seen, MOST_DISCOUNTED + 2), minlength=MOST_DISCOUNTED + 3)[: MOST_DISCOUNTED + 2].tolist()]

    @staticmethod
    def total(frame: DataFrame) -> "Level":
        """Sum of ``stats`` over the buckets' rows."""
        width = MOST_DISCOUNTED + 4
        row = frame.agg(*[F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)).alias(f"s{i}") for i in range(width)]).first()
        return Level(row[0], row[1], np.array(row[2:], np.int64))


@dataclass
class Unigrams:
    """Word probabilities from counts."""

    level: Level

    def __post_init__(self):
        self.d = discounts(self.level.of_count)
        rs = np.arange(1, MOST_DISCOUNTED + 1)
        few = self.level.of_count[1 : MOST_DISCOUNTED + 1]
        kept = float((few * rs * self.d[1:]).sum()) + float(self.level.tokens - (few * rs).sum())
        self.whole = self.level.tokens if self.level.tokens - kept > 1e-9 else self.level.tokens + 1
        self.unseen = 1 - kept / self.whole

    def probability(self, counts: np.ndarray) -> np.ndarray:
        d = np.where(counts > MOST_DISCOUNTED, 1.0, self.d[np.minimum(counts, MOST_DISCOUNTED)])
        return np.where(counts > 0, d * counts / self.whole, self.unseen)


def _chunks(docs: DataFrame, kind: str, most_tokens: int):
    """Read the texts into chunks; ``trained`` tells which documents are learned from."""

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        held, number, tokens, size = [], _Numbers(), [], 0
        for batch in slices(batches, "text"):
            for key, learn, text in zip(batch.column("doc_id").to_pylist(), batch.column("trained").to_pylist(), text_bytes(batch.column("text"))):
                words = text.lower().split()
                words.append(END)
                own = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
                held.append((key, learn, len(own)))
                tokens.append(own)
                size += len(own)
                if size >= most_tokens:
                    yield _chunk_row(part << 32 | seq, held, number, tokens, key_type)
                    seq, held, number, tokens, size = seq + 1, [], _Numbers(), [], 0
        if held:
            yield _chunk_row(part << 32 | seq, held, number, tokens, key_type)

    key_type = arrow_type(kind)
    return docs.mapInArrow(run, f"chunk long, doc_ids array<{kind}>, trained array<boolean>, lengths array<int>, words binary, counts binary, tokens binary")


class _Numbers(defaultdict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _chunk_row(chunk: int, held: list, number: dict, tokens: list, key_type: pa.DataType) -> pa.RecordBatch:
    """Words are put in the order of their hashes."""
    keys, learn, lengths = zip(*held)
    hashes = word_numbers(list(number))
    order = np.argsort(hashes, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    flat = place[np.concatenate(tokens)]
    counts = np.bincount(flat[np.repeat(learn, lengths)], minlength=len(order)).astype(np.int64)
    values = [[chunk], [keys], [learn], [lengths], [_packed_rising(hashes[order])], [_packed(counts)], [_packed(flat)]]
    types = [pa.int64(), pa.list_(key_type), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]
    names = ["chunk", "doc_ids", "trained", "lengths", "words", "counts", "tokens"]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)


def _runs(sorted_values: np.ndarray) -> list[tuple[int, int, int]]:
    """``(value, first, end)`` of each run."""
    if not len(sorted_values):
        return []
    first = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
    return list(zip(sorted_values[first].tolist(), first.tolist(), np.append(first[1:], len(sorted_values)).tolist()))


def _word_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Rising with the hash, so that a chunk's words of one bucket lie together."""
    return ((hashes >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _send_words(chunks: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for chunk, words, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "words", "counts"))):
                hashes, counts = _unpacked_rising(words, np.uint64), _unpacked(counts, np.int64)
                rows = [(b, chunk, _packed_rising(hashes[i:j]), _packed(counts[i:j])) for b, i, j in _runs(_word_bucket(hashes, buckets))]
                yield _batch(rows, ["bucket", "chunk", "words", "counts"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()])

    return chunks.select("chunk", "words", "counts").mapInArrow(run, "bucket long, chunk long, words binary, counts binary")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _count_words(sent: DataFrame, buckets: int) -> DataFrame:
    """Back to each chunk, in its order: numbers and counts of its words; chunk -1 has the bucket's totals."""

    def reduce(group: pa.Table) -> pa.Table:
        bucket, chunks = group.column("bucket")[0].as_py(), group.column("chunk").to_pylist()
        keys = [_unpacked_rising(x, np.uint64) for x in group.column("words").to_pylist()]
        counts = [_unpacked(x, np.int64) for x in group.column("counts").to_pylist()]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        rows = []
        for chunk, end, own in zip(chunks, ends.tolist(), keys):
            mine = at[end - len(own) : end]
            rows.append((bucket, chunk, _packed_rising(1 + mine.astype(np.int64) * buckets + bucket), _packed(total[mine]), None))
        rows.append((bucket, -1, None, None, Level.of(total)))
        return pa.Table.from_batches([_batch(rows, ["bucket", "chunk", "numbers", "counts", "stats"], [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())])])

    return sent.groupBy("bucket").applyInArrow(reduce, "bucket long, chunk long, numbers binary, counts binary, stats array<long>")


def _one_by_one(batch: pa.RecordBatch):
    """Rows of some MB each, only one of them unpacked at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _gathered(replies: DataFrame, *columns: str) -> DataFrame:
    """One row per chunk with what the buckets sent back, in the order of the buckets."""
    name = "_".join(columns)
    return replies.where("chunk >= 0").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", *columns))).alias(name))


def _joined(parts: list[dict], column: str, kind, rising: bool = False) -> np.ndarray:
    unpack = _unpacked_rising if rising else _unpacked
    return np.concatenate([unpack(p[column], kind) for p in parts])


def _pairs(tokens: np.ndarray, lengths: np.ndarray, wide: int) -> np.ndarray:
    """For each token, its pair as ``history * wide + word``; the history before the first word is the last number."""
    history = np.empty(len(tokens), np.int64)
    history[1:] = tokens[:-1]
    history[np.cumsum(lengths) - lengths] = wide
    return history * wide + tokens


def _pair_buckets(histories: np.ndarray, words: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = histories.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + words.astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
    return (x % np.uint64(buckets)).astype(np.int64)


def _chunk_pairs(row: dict, words: list[dict], buckets: int):
    """Of a chunk: its tokens' pairs, the distinct ones in the order they are sent in, and what they consist of."""
    numbers = np.append(_joined(words, "numbers", np.int64, rising=True), START_ID)
    counts = _joined(words, "counts", np.int64)
    tokens, lengths = _unpacked(row["tokens"], np.int32), np.array(row["lengths"], np.int64)
    pairs = _pairs(tokens, lengths, len(counts))
    distinct, at = np.unique(pairs, return_inverse=True)
    history, word = np.divmod(distinct, len(counts))
    bucket = _pair_buckets(numbers[history], numbers[word], buckets)
    order = np.lexsort((numbers[word], numbers[history], bucket))
    return numbers, counts, tokens, lengths, at, history, word, bucket, order


def _send_pairs(chunks: DataFrame, words: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in _one_by_one(batch):
                numbers, counts, _, lengths, at, history, word, bucket, order = _chunk_pairs(row, row["numbers_counts"], buckets)
                learned = np.bincount(at[np.repeat(row["trained"], lengths)], minlength=len(history)).astype(np.int64)
                bucket, h, w = bucket[order], numbers[history[order]], numbers[word[order]]
                learned, of_word = learned[order], counts[word[order]]
                rows = [(b, row["chunk"], _packed_rising(h[i:j]), _packed(w[i:j]), _packed(learned[i:j]), _packed(of_word[i:j])) for b, i, j in _runs(bucket)]
                yield _batch(rows, ["bucket", "chunk", "histories", "words", "counts", "word_counts"], [pa.int64(), pa.int64(), *[pa.binary()] * 4])

    return chunks.select("chunk", "trained", "lengths", "tokens").join(words, "chunk").mapInArrow(
        run, "bucket long, chunk long, histories binary, words binary, counts binary, word_counts binary"
    )


def _count_pairs(sent: DataFrame, buckets: int) -> DataFrame:
    """Back to each chunk: counts of its pairs. Chunk -1: totals. Chunk -2: what the pairs of histories in bucket ``of`` take.

    For a history that is, of its pairs seen 1..5 times, how many; the tokens of the others; and
    the same by the counts of the words that follow.
    """
    k = MOST_DISCOUNTED

    def reduce(group: pa.Table) -> pa.Table:
        bucket, chunks = group.column("bucket")[0].as_py(), group.column("chunk").to_pylist()
        h_parts = [_unpacked_rising(x, np.int64) for x in group.column("histories").to_pylist()]
        h = np.concatenate(h_parts)
        w = np.concatenate([_unpacked(x, np.int64) for x in group.column("words").to_pylist()])
        counts = np.concatenate([_unpacked(x, np.int64) for x in group.column("counts").to_pylist()])
        of_word = np.concatenate([_unpacked(x, np.int64) for x in group.column("word_counts").to_pylist()])
        (own_h, h), (own_w, w) = np.unique(h, return_inverse=True), np.unique(w, return_inverse=True)
        distinct, first, at = np.unique(h * np.int64(len(own_w)) + w, return_index=True, return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)
        rows, ends = [], np.cumsum([len(x) for x in h_parts]).tolist()
        for chunk, end, part in zip(chunks, ends, h_parts):
            rows.append((bucket, chunk, _packed(total[at[end - len(part) : end]]), None, None, None))
        rows.append((bucket, -1, None, None, None, Level.of(total)))
        seen = total > 0
        holder, total, follower = h[first][seen], total[seen], of_word[first][seen]
        sums = np.zeros((len(own_h), 2 * k + 2), np.int64)
        for offset, value in ((0, total), (k + 1, follower)):
            few = value <= k
            np.add.at(sums, (holder[few], offset + value[few] - 1), 1)
            np.add.at(sums, (holder[~few], offset + k), value[~few])
        used = sums.any(axis=1)
        own_h, sums = own_h[used], sums[used]
        home = (own_h - 1) % buckets
        order = np.lexsort((own_h, home))
        for b, i, j in _runs(home[order]):
            rows.append((b, -2, None, _packed_rising(own_h[order[i:j]]), _packed(sums[order[i:j]].T), None))
        return pa.Table.from_batches([_batch(rows, ["bucket", "chunk", "counts", "histories", "sums", "stats"], [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())])])

    return sent.groupBy("bucket").applyInArrow(reduce, "bucket long, chunk long, counts binary, histories binary, sums binary, stats array<long>")


def history_weights(sums: np.ndarray, unigrams: Unigrams, pair_d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """D and alpha of histories from what their pairs take (one row each)."""
    k = MOST_DISCOUNTED
    rs = np.arange(1, k + 1)
    tokens = sums[:, :k] @ rs + sums[:, k]
    kept = sums[:, :k] @ (rs * pair_d[1:]) + sums[:, k]
    whole = np.where(tokens - kept > 1e-9, tokens, tokens + 1).astype(np.float64)
    followed = (sums[:, k + 1 : 2 * k + 1] @ (rs * unigrams.d[1:]) + sums[:, 2 * k + 1]) / unigrams.whole
    return whole, (1 - kept / whole) / (1 - followed)


def _weigh_histories(replies: DataFrame, pairs: DataFrame, unigrams: Unigrams, pair_d: np.ndarray, buckets: int) -> DataFrame:
    """Back to each chunk: D and alpha of its words as histories; 0 and 1 for one that never was. The start's go to every chunk."""
    asked = replies.where("chunk >= 0").select("bucket", "chunk", "numbers", F.lit(None).cast("binary").alias("sums"))
    told = pairs.where("chunk = -2").select("bucket", "chunk", F.col("histories").alias("numbers"), "sums")

    def reduce(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        bucket = rows[0]["bucket"]
        parts = [(_unpacked_rising(r["numbers"], np.int64), _unpacked(r["sums"], np.int64).reshape(2 * MOST_DISCOUNTED + 2, -1).T) for r in rows if r["chunk"] == -2]
        if parts:
            known, at = np.unique(np.concatenate([n for n, _ in parts]), return_inverse=True)
            sums = np.zeros((len(known), 2 * MOST_DISCOUNTED + 2), np.int64)
            np.add.at(sums, at, np.concatenate([s for _, s in parts]))
            whole, alpha = history_weights(sums, unigrams, pair_d)
        else:
            known, whole, alpha = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        out = []
        for r in rows:
            if r["chunk"] == -2:
                continue
            numbers = _unpacked_rising(r["numbers"], np.int64)
            slot = np.minimum(np.searchsorted(known, numbers), max(0, len(known) - 1))
            hit = known[slot] == numbers if len(known) else np.zeros(len(numbers), bool)
            mine = [np.where(hit, x[slot] if len(known) else 0.0, other) for x, other in ((whole, 0.0), (alpha, 1.0))]
            out.append((bucket, r["chunk"], _packed(mine[0]), _packed(mine[1])))
        return pa.Table.from_batches([_batch(out, ["bucket", "chunk", "wholes", "alphas"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()])])

    return asked.unionByName(told).groupBy("bucket").applyInArrow(reduce, "bucket long, chunk long, wholes binary, alphas binary")


def _score(chunks: DataFrame, words: DataFrame, pairs: DataFrame, weights: DataFrame, start: tuple, unigrams: Unigrams, pair_d: np.ndarray, buckets: int, kind: str) -> DataFrame:
    key_type = arrow_type(kind)
    tokens_trained, kinds = unigrams.level.tokens, unigrams.level.kinds

    def run(batches):
        for batch in batches:
            for row in _one_by_one(batch):
                _, counts, tokens, lengths, at, history, word, _, order = _chunk_pairs(row, row["numbers_counts"], buckets)
                seen = np.empty(len(history), np.int64)
                seen[order] = _joined(row["counts"], "counts", np.int64)
                whole = np.append(_joined(row["wholes_alphas"], "wholes", np.float64), start[0])[history]
                alpha = np.append(_joined(row["wholes_alphas"], "alphas", np.float64), start[1])[history]
                d = np.where(seen > MOST_DISCOUNTED, 1.0, pair_d[np.minimum(seen, MOST_DISCOUNTED)])
                backed_off = alpha * unigrams.probability(counts)[word]
                logs = np.log10(np.where(seen > 0, d * seen / np.maximum(whole, 1), backed_off))
                base = np.log10((counts + 1.0) / (tokens_trained + 1.0 * (kinds + 1)))
                first = np.cumsum(lengths) - lengths
                columns = [
                    pa.array(row["doc_ids"], key_type), pa.array([not x for x in row["trained"]]), pa.array(lengths),
                    pa.array(np.add.reduceat((counts > 0)[tokens].astype(np.int64), first)),
                    pa.array(np.full(len(lengths), tokens_trained, np.int64)),
                    pa.array(np.add.reduceat(base[tokens], first)), pa.array(np.add.reduceat(logs[at], first)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    frame = chunks.select("chunk", "doc_ids", "trained", "lengths", "tokens").join(words, "chunk").join(pairs, "chunk").join(weights, "chunk")
    return frame.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(id_column: Column) -> Column:
    """The fold that is never learned from: crc32 of the id as text leaves 2 of 7."""
    return in_fold(id_column, 7, 2)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: Column | None = None, chunk_tokens: int = CHUNK_TOKENS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Learns from the rows where ``held`` (by default the fold above) is false, and scores all.
    Words are between ASCII white space with A-Z lower-cased; an end token follows them and is
    counted. ``base_score`` sums log10 of the add-one unigram probabilities, ``score`` those of
    the back-off model. A null or empty text is its end token. Repeated rows are learned from as
    often as they occur; a null id is not held out; other columns are left behind; an empty
    table gives no rows, and with nothing to learn from every score is that of unseen words.
    Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    held = held_out(docs[id_col]) if held is None else held
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), (~held).alias("trained"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    with _ChunkTable(spark, _chunks(rows, kind, chunk_tokens), buckets) as chunks:
        words = freeze(_count_words(_send_words(chunks, buckets), buckets), "katz-words")
        unigrams = Unigrams(Level.total(words.where("chunk = -1")))
        own_words = _gathered(words, "numbers", "counts")
        pairs = freeze(_count_pairs(_send_pairs(chunks, own_words, buckets), buckets), "katz-pairs")
        pair_d = discounts(Level.total(pairs.where("chunk = -1")).of_count)
        weights = _weigh_histories(words, pairs, unigrams, pair_d, buckets)
        own_pairs, own_weights = _gathered(pairs, "counts"), _gathered(weights, "wholes", "alphas")
        start = _start_weights(pairs, unigrams, pair_d)
        return freeze(_score(chunks, own_words, own_pairs, own_weights, start, unigrams, pair_d, buckets, kind), "katz-scores")


def _start_weights(pairs: DataFrame, unigrams: Unigrams, pair_d: np.ndarray) -> tuple[float, float]:
    """D and alpha of the start symbol. Its number lies in no word bucket; its parts are summed up apart."""

    def pick(batches):
        for batch in batches:
            for histories, sums in zip(batch.column("histories").to_pylist(), batch.column("sums").to_pylist()):
                if (numbers := _unpacked_rising(histories, np.int64))[0] == START_ID:
                    yield _batch([(_unpacked(sums, np.int64).reshape(-1, len(numbers))[:, 0].tolist(),)], ["stats"], [pa.list_(pa.int64())])

    parts = pairs.where("chunk = -2").select("histories", "sums").mapInArrow(pick, "stats array<long>")
    width = 2 * MOST_DISCOUNTED + 2
    row = parts.agg(*[F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)).alias(f"s{i}") for i in range(width)]).first()
    if not any(row):
        return 0.0, 1.0
    whole, alpha = history_weights(np.array([list(row)], np.int64), unigrams, pair_d)
    return float(whole[0]), float(alpha[0])


class _ChunkTable:
    """The chunks as a table bucketed by chunk, dropped with its files at the end."""

    def __init__(self, spark: SparkSession, chunks: DataFrame, buckets: int):
        self.spark, self.chunks, self.buckets = spark, chunks, min(buckets, 50_000)
        self.name, self.path = f"katz_chunks_{uuid.uuid4().hex}", scratch_path(spark, "katz-chunks")

    def __enter__(self) -> DataFrame:
        self.chunks.write.bucketBy(self.buckets, "chunk").option("path", self.path).saveAsTable(self.name)
        return self.spark.table(self.name)

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")
        delete_folder(self.spark, self.path)
