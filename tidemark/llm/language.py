"""Language of texts: script ranges narrow the candidates, a Viterbi path over words decides.

Each word is scored against every language by its letter trigrams and by itself. The path of
labels over a text's words maximises the scores less a penalty for every switch, so a lone
borrowed word does not break a span while a passage in another language does.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import id_and_text, in_fold, per_batch, slices, texts

UNKNOWN = "und"
BUCKETS = 1 << 15
#: Labelled documents of each language that the model is fitted on, at most.
SAMPLE_PER_LANGUAGE = 400
SMOOTHING, SWITCH_PENALTY, OTHER_SCRIPT = 0.5, 8.0, -30.0
#: A language counts as written in a script that at least this share of its words is in.
SCRIPT_SHARE = 0.01
CACHED_WORDS = 200_000
SLICE = 4 << 20
#: Where blocks of the code space begin, by script.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x08A0, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"),
    (0x18B0, "other"), (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CC0, "other"), (0x1D00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"),
    (0x2E00, "other"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"),
    (0x3190, "han"), (0x31F0, "kana"), (0x3200, "han"), (0xA000, "other"), (0xA640, "cyrillic"),
    (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"), (0xA8E0, "devanagari"), (0xA900, "other"),
    (0xAB30, "latin"), (0xAB70, "other"), (0xAC00, "hangul"), (0xD7FC, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB13, "armenian"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})
_STARTS = np.array([start for start, _ in SCRIPT_STARTS])
_SCRIPT_OF = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: hashed trigrams and the word itself (as one array, with each word's start),
    its number of letters, and the script most of them are in.

    Case and everything but letters is left out; a word without letters has one empty trigram.
    """
    bare = ["".join(filter(str.isalpha, w)) if not w.isalpha() else w for w in map(str.lower, words)]
    sizes = np.fromiter(map(len, bare), np.int64, len(bare))
    joined = "".join(f"\x02{w}\x03" for w in bare)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    first = np.cumsum(sizes + 2) - sizes - 2
    mix = lambda x: (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    with np.errstate(over="ignore"):
        grams = mix(mix(mix(codes[:-2] + np.uint64(1)) + codes[1:-1]) + codes[2:]) if len(codes) > 2 else codes[:0]
        powers = np.uint64(0x9E3779B97F4A7C15) * (np.arange(len(codes), dtype=np.uint64) - np.repeat(first, sizes + 2).astype(np.uint64) + np.uint64(1))
        whole = mix(np.add.reduceat(mix(codes * powers + powers), first)) if len(first) else codes[:0]
    bucket = lambda x: (x >> np.uint64(40)).astype(np.int64) % BUCKETS
    counts = np.maximum(sizes, 1) + 1
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.int64)
    is_word = np.zeros(len(out), bool)
    is_word[starts] = True
    out[is_word] = bucket(whole)
    offset = np.arange(len(out) - len(counts)) - np.repeat(np.cumsum(counts - 1) - counts + 1, counts - 1)
    at = np.repeat(first, counts - 1) + offset
    out[~is_word] = bucket(np.append(grams, np.uint64(0))[np.minimum(at, len(grams))])
    script = _SCRIPT_OF[np.searchsorted(_STARTS, codes.astype(np.int64), side="right") - 1]
    letter = codes > 3
    owner = np.repeat(np.arange(len(bare)), sizes + 2)
    votes = np.bincount(owner[letter] * len(SCRIPTS) + script[letter], minlength=len(bare) * len(SCRIPTS))
    return out, starts, sizes, votes.reshape(-1, len(SCRIPTS)).argmax(axis=1)


@dataclass
class Model:
    """Log probabilities of buckets, and which scripts each language is written in."""

    languages: list[str]
    table: np.ndarray
    written: np.ndarray

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each word in each language, and its letters; no letters score nothing."""
        buckets, starts, sizes, script = features(words)
        scores = np.add.reduceat(self.table[buckets], starts, axis=0)
        allowed = self.written[script]
        scores += np.where(allowed | ~allowed.any(axis=1, keepdims=True), 0.0, OTHER_SCRIPT)
        scores -= scores.max(axis=1, keepdims=True)
        scores[sizes == 0] = 0.0
        return scores.astype(np.float32), sizes


def fit(docs: DataFrame, lang_col: str, id_col: str = "doc_id", text_col: str = "text", per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on the rows with a language and a text.

    At most ``per_language`` documents of each language are used, those whose hashed ids are
    smallest, with their whole texts. Only hashed counts reach the driver: at most 32,768
    numbers a language.
    """
    labelled = docs.select(docs[id_col].alias("doc_id"), docs[lang_col].alias("lang"), docs[text_col].cast("string").alias("text"))
    usable = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    by_hash = Window.partitionBy("lang").orderBy("hash", "doc_id")
    # of a language with many documents only the lowest hashes are dealt out and ordered, four times as many as
    # wanted on average; the shares are a row a language, like the model, and sent to the tasks
    counts = usable.groupBy(F.col("lang").alias("of")).agg((F.lit(4.0 * per_language) / F.count("*")).alias("share"))
    low = F.col("hash").cast("double") / 2.0**64 + 0.5 <= F.col("share")
    chosen = (
        usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("hash")).join(F.broadcast(counts), F.col("lang") == F.col("of")).where(low)
        .withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= per_language)
        .select(F.col("doc_id").alias("chosen_id"), F.col("lang").alias("chosen_lang")).distinct()
    )
    # at most ``per_language`` ids a language
    sample = usable.join(F.broadcast(chosen), (F.col("doc_id").eqNullSafe(F.col("chosen_id"))) & (F.col("lang") == F.col("chosen_lang")), "left_semi")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        langs, bodies = batch.column("lang").to_pylist(), texts(batch.column("text"))
        for lang in sorted(set(langs)):
            words = list(chain.from_iterable(t.split() for t, own in zip(bodies, langs) if own == lang))
            if words:
                buckets, _, sizes, script = features(words)
                n = np.bincount(np.append(buckets, BUCKETS + script[sizes > 0]), minlength=BUCKETS + len(SCRIPTS))
                out += [(lang, int(i), int(n[i])) for i in np.flatnonzero(n)]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64())], ["lang", "bucket", "n"])

    counted = per_batch(sample, count, "lang string, bucket int, n long", "text").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counted.toArrow().to_pydict()
    languages = sorted(set(rows["lang"]))
    counts = np.zeros((len(languages), BUCKETS + len(SCRIPTS)))
    counts[[languages.index(x) for x in rows["lang"]], rows["bucket"]] = rows["n"]
    grams, scripts = counts[:, :BUCKETS] + SMOOTHING, counts[:, BUCKETS:]
    table = np.log(grams / grams.sum(axis=1, keepdims=True)).T.astype(np.float32)
    written = (scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)).T
    return Model(languages, np.ascontiguousarray(table), np.ascontiguousarray(written))


def best_paths(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word; texts of ``lengths`` words follow one another in ``scores``.

    All texts advance together, word by word, longest first, so those still running are a prefix.
    """
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = (np.cumsum(lengths) - lengths)[order], lengths[order]
    running = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
    came = np.zeros(scores.shape, np.int8 if scores.shape[1] < 128 else np.int16)
    best = np.zeros((len(sizes), scores.shape[1]), np.float64)
    own = np.arange(scores.shape[1])
    for t, k in enumerate(running.tolist()):
        at, reached = starts[:k] + t, best[:k]
        top = reached.argmax(axis=1)
        switched = reached[np.arange(k), top] - penalty
        switch = reached < switched[:, None]
        came[at] = np.where(switch, top[:, None], own)
        best[:k] = np.where(switch, switched[:, None], reached) + scores[at]
    path = np.zeros(len(scores), np.int64)
    state = best.argmax(axis=1)
    for t in range(len(running) - 1, -1, -1):
        k = running[t]
        at = starts[:k] + t
        path[at] = state[:k]
        state[:k] = came[at, state[:k]]
    return path


class Labeller:
    """Scores of words met before come from a cache that is dropped when it is full."""

    def __init__(self, model: Model, penalty: float):
        self.model, self.penalty = model, penalty
        self._reset()

    def _reset(self) -> None:
        self.slot: dict[str, int] = {}
        self.scores, self.letters = np.zeros((0, len(self.model.languages)), np.float32), np.zeros(0, np.int64)

    def label(self, batch: list[str]) -> list[tuple[str, float, list]]:
        """Language, its share of the letters, and spans ``(first word, end, language)``."""
        if not self.model.languages:
            return [(UNKNOWN, 0.0, [])] * len(batch)
        if len(self.slot) > CACHED_WORDS:
            self._reset()
        split = [t.split() for t in batch]
        words = list(chain.from_iterable(split))
        if fresh := list(set(words).difference(self.slot)):
            scores, letters = self.model.word_scores(fresh)
            self.slot.update(zip(fresh, range(len(self.slot), len(self.slot) + len(fresh))))
            self.scores, self.letters = np.concatenate([self.scores, scores]), np.concatenate([self.letters, letters])
        slots = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        del words, split  # the words of a slice take several times its bytes
        path, letters = best_paths(self.scores[slots], lengths, self.penalty), self.letters[slots]
        names, wide = self.model.languages, len(self.model.languages)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        held = np.bincount(owner * wide + path, weights=letters, minlength=len(lengths) * wide).reshape(-1, wide)
        breaks = np.flatnonzero(np.append(True, (path[1:] != path[:-1]) | (owner[1:] != owner[:-1]))) if len(path) else []
        spans: list[list] = [[] for _ in lengths]
        firsts = np.cumsum(lengths) - lengths
        for a, b in zip(breaks, [*breaks[1:], len(path)]):
            i = owner[a]
            spans[i].append({"start": int(a - firsts[i]), "end": int(b - firsts[i]), "lang": names[path[a]]})
        out = []
        for i in range(len(lengths)):
            total, top = held[i].sum(), int(held[i].argmax())
            out.append((names[top], float(held[i, top] / total), spans[i]) if total else (UNKNOWN, 0.0, []))
        return out


_labellers: dict[str, Labeller] = {}


def _labels(model: Model, penalty: float, docs: DataFrame):
    """A function from texts to labels that keeps one ``Labeller`` in each Python process."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = f"{docs.sparkSession.sparkContext.applicationId}-{shared._jbroadcast.id()}-{penalty}"

    def label(bodies: list[str]) -> list[tuple[str, float, list]]:
        if name not in _labellers:
            _labellers.clear()
            _labellers[name] = Labeller(shared.value, penalty)
        return _labellers[name].label(bodies)

    return label


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``spans`` for every row, from the text alone.

    ``score`` is the share of the text's letters in words labelled ``lang_pred``; of languages
    with equal shares the first by name is taken. ``spans`` are runs of words, split at white
    space, with one label. A text that is null or has no letter, and any text under a model
    that has seen no language, is ``und`` with score 0 and no spans. Repeated rows are each
    labelled, other columns are left behind, and an empty table gives no rows.
    """
    narrow = id_and_text(docs, id_col, text_col)
    label = _labels(model, penalty, docs)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches):
        for batch in slices(batches, "text", SLICE):
            made = list(zip(*label(texts(batch.column("text"))))) or [(), (), ()]
            columns = [pa.array(made[0], pa.string()), pa.array(made[1], pa.float64()), pa.array(made[2], span)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "lang_pred", "score", "spans"])

    return narrow.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")


def keep_labelled(docs: DataFrame, model: Model, least_share: float, text_col: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """The rows whose text has a language that holds ``least_share`` of its letters, columns as they were.

    Each row is judged by its own text, so repeated rows and ids do not matter.
    """
    label = _labels(model, penalty, docs)

    def run(batches):
        for batch in slices(batches, text_col, SLICE):
            kept = [name != UNKNOWN and share >= least_share for name, share, _ in label(texts(batch.column(text_col)))]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_column: Column) -> Column:
    """The fold that is never learned from: crc32 of the id as text leaves 1 of 3."""
    return in_fold(id_column, 3, 1)


def fit_on_folds(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", **how) -> Model:
    """Fit on the documents outside the held-out fold."""
    return fit(docs.where(~held_out(docs[id_col])), lang_col, id_col=id_col, **how)
