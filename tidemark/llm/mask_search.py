"""Ranked lexical search by presence masks: the exact top documents of every item.

A shard of the documents holds, for each term that some item asks for, which of its documents
have the term and how often. For an item the bitmaps of its terms are laid on top of each other
and turned round, which gives every document the mask of the terms it matches; documents of one
mask are a group. No document scores more than the best gains of its mask's terms together, so
groups are scored by falling bound until the next bound is below the k-th best score found.

Document counts and lengths are those of all documents, taken from the shards once, so the best
rows of the tasks together hold the best of all. Items are searched for in blocks of bounded
size; each block reads the shards once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm import katz
from tidemark.llm.batches import slices, text_bytes
from tidemark.workspace import freeze, scratch_path

#: A shard is closed at so many documents or postings.
SHARD_DOCUMENTS, SHARD_POSTINGS = 1 << 14, 1 << 20
#: A block of items is closed at so many items or terms; it is all that the driver holds and sends of them.
BLOCK_ITEMS, BLOCK_TERMS = 1024, 1 << 18
#: With at most so many terms in all items the shards leave other terms out; with more they keep every term.
SENT_TERMS = 1 << 18
#: Documents scored first for an item, then twice as many each time; bytes of the bits laid open at once.
SCORED_FIRST, OPEN_BYTES = 128, 1 << 24

#: Digits, letters with A-Z lower-cased, and all bytes beyond ASCII; the other bytes end a term.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))

SHARD = "n long, words long, lengths binary, sizes binary, terms array<string>, counts array<long>, owners binary, times binary"


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of characters beyond ASCII, only A-Z lower-cased."""
    return text.translate(_FOLD).split()


def _item_rows(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item_id`` and its distinct ``terms``, once for equal rows; items without a term are left out."""
    rows = items.select(items[item_col].alias("item_id"), items[text_col].cast("string").alias("text")).distinct()
    kind = to_arrow_type(rows.schema["item_id"].dataType)

    def run(batches):
        for batch in slices(batches, "text"):
            found = [sorted(set(terms(t))) for t in text_bytes(batch.column("text"))]
            keep = [i for i, f in enumerate(found) if f]
            columns = [batch.column("item_id").take(pa.array(keep, pa.int64())).cast(kind), pa.array([[t.decode() for t in found[i]] for i in keep], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "terms"])

    return rows.mapInArrow(run, f"item_id {rows.schema['item_id'].dataType.simpleString()}, terms array<string>")


def _shard_rows(docs: DataFrame, id_col: str, text_col: str, wanted: frozenset | None) -> DataFrame:
    """One row for each shard: totals over all its documents, and the postings of the wanted terms."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    plain = rows.schema["doc_id"].dataType
    kind = to_arrow_type(plain)

    def run(batches):
        made = _ShardMaker(kind)
        for batch in slices(batches, "text"):
            for key, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text"))):
                times = Counter(terms(text))
                made.add(key, times, times.keys() if wanted is None else wanted & times.keys())
                if made.full():
                    yield made.row()
                    made = _ShardMaker(kind)
        if made.n:
            yield made.row()

    return rows.mapInArrow(run, f"doc_ids array<{plain.simpleString()}>, {SHARD}")


class _ShardMaker:
    def __init__(self, kind: pa.DataType):
        self.kind, self.n, self.words, self.number = kind, 0, 0, {}
        self.keys, self.lengths, self.sizes, self.places, self.times = [], [], [], [], []

    def add(self, key, times: Counter, held) -> None:
        """Only documents with a term count, and only those with a wanted one are kept."""
        if not times:
            return
        self.n, length = self.n + 1, times.total()
        self.words += length
        if held:
            number = self.number
            self.keys.append(key)
            self.lengths.append(length)
            self.sizes.append(len(held))
            self.places += [number.setdefault(t, len(number)) for t in held]
            self.times += [times[t] for t in held]

    def full(self) -> bool:
        return len(self.keys) >= SHARD_DOCUMENTS or len(self.places) >= SHARD_POSTINGS

    def row(self) -> pa.RecordBatch:
        places, sizes = np.array(self.places, np.int32), np.array(self.sizes, np.int64)
        owners = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        order = np.lexsort((owners, places))
        values = [
            self.keys, self.n, self.words, katz._packed(np.array(self.lengths, np.int64)), katz._packed(sizes), [t.decode() for t in self.number],
            np.bincount(places, minlength=len(self.number)).tolist(), katz._packed(owners[order]), katz._packed(np.array(self.times, np.int64)[order]),
        ]
        names = ["doc_ids", *(part.split()[0] for part in SHARD.split(", "))]
        kinds = [pa.list_(self.kind), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


def weight(n: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * held + 1)))


class Shard:
    """A shard's postings by term, with what each adds to a score for one unit of weight."""

    def __init__(self, row: dict, n: int, words: int):
        self.doc_ids = row["doc_ids"]
        self.number = {t: i for i, t in enumerate(row["terms"])}
        counts = np.array(row["counts"], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        self.owners = katz._unpacked(row["owners"], np.int32)
        times, lengths = katz._unpacked(row["times"], np.int64), katz._unpacked(row["lengths"], np.int64)
        middle = 50 + 50 * lengths * n // max(words, 1)
        self.gains = 1_000_000_000 * times // (1000 * times + 20 * middle[self.owners])
        self.most = np.maximum.reduceat(self.gains, self.starts[:-1]) if len(counts) else np.zeros(0, np.int64)
        # the same postings by document
        order = np.argsort(self.owners, kind="stable")
        self.doc_terms = np.repeat(np.arange(len(counts)), counts)[order]
        self.doc_gains = self.gains[order]
        self.doc_starts = np.concatenate([[0], np.cumsum(katz._unpacked(row["sizes"], np.int64))])
        self.weights = np.zeros(len(counts), np.int64)
        self.bitmaps: dict[int, np.ndarray] = {}
        by_id = sorted(range(len(self.doc_ids)), key=lambda i: id_order(self.doc_ids[i]))
        self.place_of_id = np.empty(len(by_id), np.int64)
        self.place_of_id[by_id] = np.arange(len(by_id))

    def bitmap(self, term: int) -> np.ndarray:
        """A bit for each document of the shard: whether it has the term."""
        if term not in self.bitmaps:
            bits = np.zeros(len(self.doc_ids), np.uint8)
            bits[self.owners[self.starts[term] : self.starts[term + 1]]] = 1
            self.bitmaps[term] = np.packbits(bits)
        return self.bitmaps[term]

    def groups(self, own: list[int], first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct masks of documents ``first`` to ``last`` as rows of bits, and each document's mask."""
        laid = np.stack([self.bitmap(t)[first // 8 : -(-last // 8)] for t in own])
        turned = np.packbits(np.unpackbits(laid, axis=1, count=last - first), axis=0).T
        wide = -(-len(own) // 8)
        if wide <= 8:
            padded = np.zeros((last - first, 8), np.uint8)
            padded[:, :wide] = turned
            masks, mask_of = np.unique(padded.view(np.uint64).ravel(), return_inverse=True)
            masks = masks.view(np.uint8).reshape(-1, 8)
        else:
            masks, mask_of = np.unique(np.ascontiguousarray(turned).view(f"V{wide}").ravel(), return_inverse=True)
            masks = np.frombuffer(masks.tobytes(), np.uint8).reshape(-1, wide)
        return np.unpackbits(masks, axis=1, count=len(own)), mask_of

    def scores(self, places: np.ndarray) -> np.ndarray:
        """Exact scores of documents under ``weights``."""
        starts, sizes = self.doc_starts[places], self.doc_starts[places + 1] - self.doc_starts[places]
        ends = np.cumsum(sizes)
        at = np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])
        return np.add.reduceat(self.weights[self.doc_terms[at]] * self.doc_gains[at], ends - sizes)

    def search(self, asked: dict[str, int], k: int, best: list[tuple]) -> list[tuple]:
        """``best`` (rising ``(-score, id_order, id)``) with this shard's documents taken in; ``asked`` gives the terms' weights."""
        own = sorted({self.number[t]: w for t, w in asked.items() if w and t in self.number}.items())
        if not own:
            return best
        places, weights = [t for t, _ in own], np.array([w for _, w in own], np.int64)
        self.weights[places] = weights
        most = (weights * self.most[places]).astype(np.float64)
        step = max(8, OPEN_BYTES // len(own) // 8 * 8)
        for first in range(0, len(self.doc_ids), step):
            masks, mask_of = self.groups(places, first, min(first + step, len(self.doc_ids)))
            # the slack only covers rounding of sums beyond 2**53
            bounds = (masks @ most) * (1 + 1e-12) + (most.sum() >= 2**53)
            best = self._by_falling_bound(bounds, mask_of, first, k, best)
        self.weights[places] = 0
        return best

    def _by_falling_bound(self, bounds: np.ndarray, mask_of: np.ndarray, first: int, k: int, best: list[tuple]) -> list[tuple]:
        order = np.argsort(-bounds, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        docs = np.argsort(rank[mask_of], kind="stable")
        ends = np.cumsum(np.bincount(rank[mask_of], minlength=len(order)))
        bounds, at, done, step = bounds[order], 0, 0, SCORED_FIRST
        while at < len(bounds) and bounds[at] > 0 and (len(best) < k or bounds[at] >= -best[-1][0]):
            at = max(at + 1, int(np.searchsorted(ends, done + step, "right")))
            chosen = np.sort(docs[done : ends[at - 1]]) + first
            done, step = int(ends[at - 1]), step * 2
            scores = self.scores(chosen)
            keep = scores >= (-best[-1][0] if len(best) >= k else 1)
            chosen, scores = chosen[keep], scores[keep]
            top = np.lexsort((self.place_of_id[chosen], -scores))[:k]
            found = [(-s, id_order(self.doc_ids[p]), self.doc_ids[p]) for p, s in zip(chosen[top].tolist(), scores[top].tolist())]
            if found:
                best = sorted(best + found, key=lambda x: x[:2])[:k]
        return best


def id_order(key) -> tuple:
    """Ids in Spark's order, null last; texts go by their bytes."""
    return (True, 0) if key is None else (False, key.encode() if isinstance(key, str) else key)


def _blocks(asked: DataFrame) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size, read one after the other."""
    block, size = [], 0
    for row in asked.toLocalIterator():
        block.append((row["item_id"], row["terms"]))
        size += len(row["terms"])
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_TERMS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _best_of_tasks(index: DataFrame, block: list[tuple], weights: dict[str, int], n: int, words: int, k: int, item_kind, doc_kind) -> DataFrame:
    """At most ``k`` rows of each item from each task."""
    asked = [{t: weights[t] for t in own} for _, own in block]
    item_ids = [item for item, _ in block]
    arrow = [pa.int64(), to_arrow_type(item_kind), to_arrow_type(doc_kind), pa.int64()]

    def run(batches):
        best: list[list[tuple]] = [[] for _ in asked]
        for batch in batches:
            for row in katz._one_by_one(batch):
                shard = Shard(row, n, words)
                best = [shard.search(own, k, so_far) for own, so_far in zip(asked, best)]
        found = [(number, item_ids[number], key, -s) for number, rows in enumerate(best) for s, _, key in rows]
        columns = list(zip(*found)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow)], ["number", "item_id", "doc_id", "score"])

    schema = f"number long, item_id {item_kind.simpleString()}, doc_id {doc_kind.simpleString()}, score long"
    return index.mapInArrow(run, schema)


def top_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best rows of ``docs`` for each row of ``items``.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII in the whole text,
    only A-Z lower-cased. ``N`` is the number of documents with a term, ``L`` that of all their terms,
    ``n`` that of one document's; ``df`` of them hold a term, which occurs ``tf`` times in one. With
    ``w = floor(1000 ln((2N+2)/(2df+1)))`` and ``m = 50 + 50nN div L`` the score is the sum of
    ``w * (10^9 tf div (1000 tf + 20m))`` over the item's distinct terms, in whole numbers.

    Only scores above 0 count, so an item may have fewer rows, and one without a term (null,
    empty) has none. Equal scores rank by id, null last. Repeated documents are separate results;
    a repeated item row gives one list, two texts under one item id a list each. Other columns are
    left behind; an empty table on either side gives no rows.
    """
    asked = freeze(_item_rows(items, item_col, item_text_col), "mask-items")
    held = asked.select(F.explode("terms").alias("term")).distinct()
    wanted = held.limit(SENT_TERMS + 1).collect()
    known = frozenset(r.term.encode() for r in wanted) if len(wanted) <= SENT_TERMS else None
    index = freeze(_shard_rows(docs, id_col, text_col, known), "mask-shards")
    n, words = index.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    counted = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy(F.col("x.terms").alias("term"))
    counts = freeze(counted.agg(F.sum("x.counts").alias("df")), "mask-counts")

    item_kind, doc_kind = asked.schema["item_id"].dataType, index.schema["doc_ids"].dataType.elementType
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    schema = f"item_id {item_kind.simpleString()}, rank int, doc_id {doc_kind.simpleString()}, score long"
    path = None
    for block in _blocks(asked):
        own = docs.sparkSession.createDataFrame([(t,) for t in sorted({t for _, ts in block for t in ts})], "term string")
        df = dict(counts.join(own, "term").collect())
        weights = {t: weight(n, df[t]) if t in df else 0 for _, ts in block for t in ts}
        found = _best_of_tasks(index, block, weights, n, words, k, item_kind, doc_kind)
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        path = path or scratch_path(docs.sparkSession, "mask-found")
        ranked.select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(path)
    reader = docs.sparkSession.read.schema(schema)
    return reader.parquet(path) if path else docs.sparkSession.createDataFrame([], schema)
