"""Byte-level BPE: encoding with a segment tree over the ranks of adjacent pairs, and decoding.

The words of a batch that the task has not met yet are encoded together, as rows of NumPy
arrays. Each row has a segment tree whose leaf ``i`` holds ``rank * leaves + i`` of the pair
that starts at symbol ``i``, so the root is the leftmost pair of lowest rank. A merge changes
three leaves at most; each is carried to the root in logarithmic time. A word is done when its
root holds no mergeable pair.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.batches import per_batch, texts
from tidemark.llm.wordcache import WordCache

#: Fixed value: the splitting pattern of the byte-level pre-tokenizer.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
NONE = np.iinfo(np.int64).max
#: The same for texts of the characters in ``COMMON`` only, whose classes are plain to see.
COMMON_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+| ?[0-9²³¹¼-¾]+| ?[^ \t\n\r\f\vA-Za-zªµºÀ-ÖØ-öø-ɏ0-9²³¹¼-¾]+|[ \t\n\r\f\v]+(?![^ \t\n\r\f\v])|[ \t\n\r\f\v]+"
)
COMMON = frozenset(map(chr, [*range(0x80), *range(0xA1, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x203F), 0x20AC]))
#: Entries of the trees that are worked on at once, and of the word cache of a task's process.
TREE_ENTRIES, CACHED_WORDS, CACHED_CHARS = 1 << 19, 400_000, 16 << 20


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in own)
    shifted = {b: chr(0x100 + i) for i, b in enumerate(rest)}
    return [shifted.get(b, chr(b)) for b in range(256)]


@lru_cache(1)
def _newer_letters() -> regex.Pattern:
    """Code points this Python knows nothing of: libraries may class them differently."""
    unknown = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    starts = [c for i, c in enumerate(unknown) if i == 0 or unknown[i - 1] != c - 1]
    stops = [c for i, c in enumerate(unknown) if i + 1 == len(unknown) or unknown[i + 1] != c + 1]
    return regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, stops)) + "]")


class Vocabulary:
    """Pair ranks, merged ids and id bytes of a byte-level BPE tokenizer file."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("a plain byte-level BPE tokenizer is needed")
        ids = spec["model"]["vocab"]
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.first = np.array([ids[c] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)
        self.byte_ranks = self._ranks(*(x.reshape(-1) for x in np.meshgrid(self.first, self.first, indexing="ij")))
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        pieces = {i: bytes(of_letter[c] for c in token) for token, i in ids.items()}
        pieces |= {i: text.encode() for text, i in self.special.items()}
        by_id = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.piece_sizes = np.array([*map(len, by_id), 0], np.int64)
        self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        self.piece_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.library = Tokenizer.from_str(content.decode()).pre_tokenizer

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs (a, b), -1 where they do not merge."""
        key = a << 32 | b
        slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[slot] == key, self.ranks[slot], -1)

    def leaf(self, rank: np.ndarray, leaves: int, at: np.ndarray) -> np.ndarray:
        return np.where(rank >= 0, rank * leaves + at, NONE)

    def pair_leaf(self, a: np.ndarray, b: np.ndarray, leaves: int, at: np.ndarray) -> np.ndarray:
        """Leaf values of the pairs (a, b) that start at ``at``; a ``b`` below zero is no pair."""
        return self.leaf(np.where(b >= 0, self._ranks(a, np.maximum(b, 0)), -1), leaves, at)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes the ids stand for; an id outside the vocabulary stands for none."""
        ids = np.where((ids >= 0) & (ids < len(self.piece_sizes)), ids, len(self.piece_sizes) - 1)
        sizes = self.piece_sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.piece_starts[ids] - ends + sizes, sizes) + np.arange(int(sizes.sum()))
        return self.piece_bytes[at].tobytes()

    def split(self, text: str) -> list[str]:
        """The pre-tokenizer's words, special tokens apart."""
        if self.special_pattern is None or not self.special_pattern.search(text):
            return self._words(text)
        out = []
        for part in self.special_pattern.split(text):
            out += [part] if part in self.special else self._words(part)
        return out

    def _words(self, text: str) -> list[str]:
        if text.isascii() or COMMON.issuperset(text):
            return COMMON_WORDS.findall(text)
        if _newer_letters().search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return WORDS.findall(text)


@lru_cache(2)
def vocabulary(content: bytes) -> Vocabulary:
    """Read once in each Python process."""
    return Vocabulary(content)


def merge_words(vocab: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids, and where each word's ids start and how many they are."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    made, total = [], 0
    leaves_of = 1 << np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64)
    for leaves in np.unique(leaves_of).tolist():
        group = np.flatnonzero(leaves_of == leaves)
        step = max(1, TREE_ENTRIES // (2 * leaves))
        for at in range(0, len(group), step):
            rows = group[at : at + step]
            ids, counts[rows] = _merge_rows(vocab, [words[i] for i in rows.tolist()], sizes[rows], leaves)
            starts[rows] = total + np.cumsum(counts[rows]) - counts[rows]
            total += len(ids)
            made.append(ids.astype(np.int32))
    return (np.concatenate(made) if made else np.zeros(0, np.int32)), starts, counts


def _merge_rows(vocab: Vocabulary, words: list[bytes], sizes: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words of at most ``leaves`` bytes, one after the other, and how many each has."""
    n, wide = len(words), leaves + 1
    inside = np.arange(wide) < sizes[:, None]
    symbols, letters = np.full((n, wide), -1, np.int64), np.zeros((n, wide), np.int64)
    letters[inside] = np.frombuffer(b"".join(words), np.uint8)
    symbols[inside] = vocab.first[letters[inside]]
    following = np.where(np.arange(1, wide + 1) < sizes[:, None], np.arange(1, wide + 1), leaves)
    before = np.broadcast_to(np.arange(-1, wide - 1), (n, wide)).copy()
    tree = np.full((n, 2 * leaves), NONE, np.int64)
    row, at = np.nonzero(inside[:, 1:])
    tree[row, leaves + at] = vocab.leaf(vocab.byte_ranks[letters[row, at] * 256 + letters[row, at + 1]], leaves, at)
    half = leaves
    while half > 1:
        tree[:, half // 2 : half] = np.minimum(tree[:, half : 2 * half : 2], tree[:, half + 1 : 2 * half : 2])
        half //= 2
    alive, flat = inside.copy(), tree.reshape(-1)
    active = np.flatnonzero(tree[:, 1] < NONE)
    while active.size:
        rank, left = np.divmod(tree[active, 1], leaves)
        right = following[active, left]
        after = following[active, right]
        prior = before[active, left]
        new = vocab.merged[rank]
        symbols[active, left] = new
        alive[active, right] = False
        following[active, left] = after
        before[active, after] = left
        has_prior = prior >= 0
        prior = np.where(has_prior, prior, left)
        with_after = vocab.pair_leaf(new, symbols[active, after], leaves, left)
        with_prior = np.where(has_prior, vocab.pair_leaf(symbols[active, prior], new, leaves, prior), with_after)
        base = active * (2 * leaves)
        node = np.stack([right, prior, left]) + leaves
        flat[base + node[0]], flat[base + node[1]], flat[base + node[2]] = NONE, with_prior, with_after
        while node[0, 0] > 1:
            node >>= 1
            children = base + 2 * node
            flat[base + node] = np.minimum(flat[children], flat[children + 1])
        active = active[tree[active, 1] < NONE]
    alive = alive[:, :leaves]
    return symbols[:, :leaves][alive], alive.sum(axis=1)


def learn_words(vocab: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``merge_words``, for words some of which may be special tokens."""
    special = np.array([vocab.special.get(w, -1) for w in words], np.int64)
    ids, starts, counts = merge_words(vocab, [b"" if i >= 0 else w.encode() for w, i in zip(words, special.tolist())])
    starts[special >= 0], counts[special >= 0] = len(ids) + np.arange(int((special >= 0).sum())), 1
    return np.concatenate([ids, special[special >= 0].astype(np.int32)]), starts, counts


@lru_cache(2)
def encoder(content: bytes) -> WordCache:
    vocab = vocabulary(content)
    return WordCache(vocab.split, partial(learn_words, vocab), CACHED_WORDS, CACHED_CHARS)


def tokenizer_content(path: str) -> bytes:
    """The tokenizer file as bytes, so that executors need not have it; it is a few MB."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col`` (array of int): the text's ids under the tokenizer file ``path``.

    The ids are those of the tokenizers library without its own special tokens, truncation or
    padding; special tokens written out in a text become their ids. Null and empty texts have
    no ids. Every row and column stays, and a column that has the name ``ids_col`` is replaced.
    """
    content = tokenizer_content(path)
    docs = docs.drop(ids_col)
    schema = docs.withColumn(ids_col, F.lit(None).cast("array<int>")).schema

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, offsets = encoder(content).encode(texts(batch.column(text_col)))
        made = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, ids_col])

    return per_batch(docs, step, schema, text_col)


def decode(frame: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``frame`` with ``text_col``: the text its ids stand for, special tokens written out.

    Bytes that are not UTF-8 become U+FFFD; an id outside the vocabulary adds nothing; null
    ids give an empty text.
    """
    content = tokenizer_content(path)
    frame = frame.drop(text_col)
    schema = frame.withColumn(text_col, F.lit(None).cast("string")).schema

    def run(batches):
        vocab = vocabulary(content)
        for batch in batches:
            column = batch.column(ids_col)
            flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(sizes, dtype=np.int64)
            out = [vocab.decode(flat[e - n : e]).decode("utf-8", "replace") for e, n in zip(ends.tolist(), sizes.tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, text_col])

    return frame.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """`encode` and `decode` in one pass: ``docs`` without its text, with ``ids_col`` and ``decoded_col``.

    A task needs one Python process for both, and the text goes to it once.
    """
    content = tokenizer_content(path)
    docs = docs.drop(ids_col, decoded_col)
    schema = docs.drop(text_col).withColumns({ids_col: F.lit(None).cast("array<int>"), decoded_col: F.lit(None).cast("string")}).schema

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocab = vocabulary(content)
        ids, offsets = encoder(content).encode(texts(batch.column(text_col)))
        decoded = [vocab.decode(ids[a:b]).decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        others = [name for name in batch.schema.names if name != text_col]
        made = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())), pa.array(decoded, pa.string())]
        return pa.RecordBatch.from_arrays([*map(batch.column, others), *made], [*others, ids_col, decoded_col])

    return per_batch(docs, step, schema, text_col)


def digest(coded: DataFrame) -> DataFrame:
    """Id count and SHA-256 of the ids and of the decoded text."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
