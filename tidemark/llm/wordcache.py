"""Encoding texts word by word, where words come again and again."""

from __future__ import annotations

from collections.abc import Callable
from itertools import islice

import numpy as np


class Slots(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class WordCache:
    """Ids of texts from ids of their words.

    ``split`` cuts a text into words whose ids do not depend on each other; ``learn`` gives, for
    new words, all ids, and where each word's start and how many they are. The cache lives as
    long as the Python process; when it passes ``most_words`` or ``most_chars``, the words used
    most stay, up to a quarter of that.
    """

    def __init__(self, split: Callable, learn: Callable, most_words: int, most_chars: int):
        self.split, self.learn = split, learn
        self.most_words, self.most_chars = most_words, most_chars
        self.slots, self.chars = Slots(), 0
        self.ids, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def _shrink(self) -> None:
        words = list(self.slots)
        by_use = np.argsort(-self.uses, kind="stable")[: self.most_words // 4]
        chars = np.cumsum([len(words[i]) for i in by_use.tolist()], dtype=np.int64)
        kept = np.sort(by_use[chars <= self.most_chars // 4])
        self.slots, self.chars = Slots(zip((words[i] for i in kept.tolist()), range(len(kept)))), sum(len(words[i]) for i in kept.tolist())
        self.counts = self.counts[kept]
        ends = np.cumsum(self.counts)
        self.ids = self.ids[np.repeat(self.starts[kept] - ends + self.counts, self.counts) + np.arange(int(self.counts.sum()))]
        self.starts, self.uses = ends - self.counts, self.uses[kept] // 2

    def _add(self, words: list[str]) -> None:
        ids, starts, counts = self.learn(words)
        self.starts = np.concatenate([self.starts, len(self.ids) + starts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])
        self.chars += sum(map(len, words))

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the offsets of each text's ids."""
        if len(self.slots) > self.most_words or self.chars > self.most_chars:
            self._shrink()
        known, sizes, parts = len(self.slots), [], []
        for text in batch:
            words = self.split(text)
            sizes.append(len(words))
            parts.append(np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words)))
        if len(self.slots) > known:
            self._add(list(islice(self.slots, known, None)))
        slots = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.uses = np.bincount(slots, minlength=len(self.slots)) + np.append(self.uses, np.zeros(len(self.slots) - len(self.uses), np.int64))
        counts = self.counts[slots]
        ends = np.cumsum(counts)
        ids = self.ids[np.repeat(self.starts[slots] - ends + counts, counts) + np.arange(int(counts.sum()))]
        return ids, np.append(0, np.append(0, ends)[np.cumsum(sizes, dtype=np.int64)])
