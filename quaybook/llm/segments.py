"""Texts as codes of distinct words, and a bounded store of what is known of
each word.

A batch of texts is split at spaces and its words are numbered by Arrow, so
Python sees each distinct word of a batch once, however often it occurs. A
``WordStore`` keeps a run of numbers (ids, say) for each word that it has
seen; a batch's words become slots of the store, and the numbers of whole
texts are gathered by array indexing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_WORDS = 700_000  # that a store keeps
MAX_CHARS = 1 << 25  # in all of its words
NO_WORDS = np.empty(0, dtype=np.int64)


def split_at_spaces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(offsets of the texts' words, their codes, the distinct words): as
    ``str.split(" ")`` cuts each text, so n spaces give n + 1 words."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    coded = lists.flatten().dictionary_encode()
    return (lists.offsets.to_numpy().astype(np.int64), coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist())


def text_blocks(texts: pa.Array, most: int) -> Iterator[tuple[int, int, bool]]:
    """(first row, end row, whether it is one text longer than ``most`` bytes)
    of blocks of at most that many bytes."""
    ends = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield at, end, bool(ends[end] - ends[at] > most)
        at = end


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values[offsets[i]:offsets[i + 1]]."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[offsets[1:]] - total[offsets[:-1]]


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs flat[start:start + count], one behind the other."""
    before = np.cumsum(counts) - counts
    return flat[np.repeat(starts - before, counts) + np.arange(counts.sum())]


class WordStore:
    """A run of numbers for each known word. ``encode`` gives (all numbers,
    start and count of each word) of new words. A store that has grown beyond
    its bound forgets the words that came in one batch only, and if need be
    those of few batches."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        """Forget all words."""
        self.place: dict[str, int] = {}
        self.chars = 0
        self.flat = np.empty(0, dtype=np.int32)
        self.starts = self.counts = self.uses = NO_WORDS  # uses: in how many batches, halved at each forgetting

    def _forget(self) -> None:
        words, least = list(self.place), 2
        kept = np.flatnonzero(self.uses >= least)
        while len(kept) > MAX_WORDS // 2:
            least *= 2
            kept = np.flatnonzero(self.uses >= least)
        flat, counts = self.numbers(kept)
        words, uses = [words[i] for i in kept.tolist()], self.uses[kept] // 2
        self.clear()
        if sum(map(len, words)) <= MAX_CHARS // 2:
            self.place = {w: i for i, w in enumerate(words)}
            self.chars = sum(map(len, words))
            self.flat, self.starts, self.counts, self.uses = flat, np.cumsum(counts) - counts, counts, uses

    def slots(self, words: list[str]) -> np.ndarray:
        """The slot of each of the (distinct) words."""
        if len(self.place) > MAX_WORDS or self.chars > MAX_CHARS:
            self._forget()
        place = self.place
        found = np.array([place.get(w, -1) for w in words], dtype=np.int64)
        new = np.flatnonzero(found < 0)
        self.uses[found[found >= 0]] += 1
        if len(new):
            missing = [words[i] for i in new]
            flat, starts, counts = self.encode(missing)
            found[new] = np.arange(len(place), len(place) + len(new))
            self.chars += sum(map(len, missing))
            self.starts = np.concatenate((self.starts, starts + len(self.flat)))
            self.counts = np.concatenate((self.counts, counts))
            self.uses = np.concatenate((self.uses, np.ones(len(new), dtype=np.int64)))
            self.flat = np.concatenate((self.flat, flat.astype(np.int32, copy=False)))
            place.update(zip(missing, found[new].tolist(), strict=True))
        return found

    def numbers(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the numbers of the words in these slots, how many each has)."""
        counts = self.counts[slots]
        return gather(self.flat, self.starts[slots], counts) if len(self.flat) else self.flat, counts
