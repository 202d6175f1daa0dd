"""Encoding and decoding with a merge-type piece vocabulary.

A word starts as its characters. All adjacent pairs whose joined text is a
piece stand in an agenda ordered by score, the place further left first on
equal scores; the best pair is merged, its entry and those of its two
neighbours are made anew, and so on until the agenda is empty. What is left
and isn't in the vocabulary is written as byte pieces. Many words are worked
on at once: an agenda is a row of an array with one entry for each place, and
in each step the best entry of every row is taken. Words too long for that
have a heap each, whose stale entries are skipped when they come up.

No piece holds a word separator behind another character, so merges never
cross the border before a run of spaces. Each Arrow batch is therefore cut
into pre-tokens, the agendas run once for each distinct one that is new to the
worker, and a document's ids are those of its pre-tokens in a row. Every Arrow
batch checks its new pre-tokens against the sentencepiece library and the job
fails on a difference; ``audit`` compares whole texts. Nothing is shuffled and
no key is gathered anywhere, so hot sources and copies make no difference. A
worker keeps a bounded number of pre-tokens (``segments.WordStore``); one that
was forgotten is encoded again.

Models that rewrite text, merge across word borders, have pieces that are
unused or aren't plain merges, or have no byte pieces, are refused.

Null and empty texts have no ids and decode to the empty text. Null id lists
decode to the empty text. Repeated rows are encoded one by one, null document
ids are kept, extra columns are left out, an empty input gives an empty
result. Texts longer than a block are encoded block by block.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quaybook.llm.common import pick, prepare
from quaybook.llm.segments import WordStore, gather, sums, text_blocks
from quaybook.llm.token_counts import SEPARATOR, check_splittable, coded_pre_tokens

BLOCK_BYTES = 1 << 21  # of texts that are gathered at a time
ROW_CHARS = 40  # longer words get a heap of their own
ROWS = 4096  # words that are merged together
SYMBOL_BITS = 22  # pieces and characters without a piece


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    """A byte that is no part of a character becomes U+FFFD by itself."""
    return "�", error.start + 1


codecs.register_error("quaybook-one-byte", _one_byte)


class MergeVocabulary:
    """Pieces, scores and the surface of every id of a merge-type model.

    A symbol is the id of a piece, or the number of pieces and a code point
    for a character without one."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = p = sentencepiece.SentencePieceProcessor(model_proto=model)
        check_splittable(p)
        if p.normalize("ﬁ Á ") != f"{SEPARATOR}ﬁ{SEPARATOR}Á{SEPARATOR}":
            raise ValueError("the model rewrites text")
        self.size = p.get_piece_size()
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_ids = np.full(256, -1, dtype=np.int64)
        self.surface: list[bytes] = []
        for i in range(self.size):
            piece = p.id_to_piece(i)
            if p.is_unused(i):
                raise ValueError(f"unused piece {piece!r}")
            if p.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif p.is_control(i):
                self.surface.append(b"")
            elif p.is_unknown(i):
                self.surface.append(p.decode([i]).encode())
            else:
                self.ids[piece], self.score[piece] = i, p.get_score(i)
                self.surface.append(piece.replace(SEPARATOR, " ").encode())
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        self.spaced = np.array([p.id_to_piece(i).startswith(SEPARATOR) for i in range(self.size)])
        self.surface_size = np.array([len(s) for s in self.surface], dtype=np.int64)
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size
        self.surface_bytes = np.frombuffer(b"".join(self.surface), dtype=np.uint8)
        self.symbol_of = self.size + np.arange(0x110000, dtype=np.int64)  # of each code point
        pairs: dict[int, tuple[float, int]] = {}
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self._symbol(piece[:cut]), self._symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << SYMBOL_BITS | right] = (-self.score[piece], i)
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_cost = np.array([pairs[k][0] for k in self.pair_keys.tolist()])
        self.pair_piece = np.array([pairs[k][1] for k in self.pair_keys.tolist()], dtype=np.int64)

    def _symbol(self, text: str) -> int | None:
        return int(self.symbol_of[ord(text)]) if len(text) == 1 else self.ids.get(text)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cost, piece) of joined symbols; the cost is infinite if they are no piece."""
        key = left << SYMBOL_BITS | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_cost[at], np.inf), self.pair_piece[at]

    def _rows(self, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(merged symbols of all rows, their number in each row) of rows of
        symbols, of which the first ``size`` count."""
        n, width = symbols.shape
        column = np.arange(width)
        alive = column < size[:, None]
        after, before = np.tile(column + 1, (n, 1)), np.tile(column - 1, (n, 1))
        agenda, piece = np.full((n, width), np.inf), np.zeros((n, width), dtype=np.int64)
        if width > 1:
            agenda[:, :-1], piece[:, :-1] = self._pair(symbols[:, :-1], symbols[:, 1:])
            agenda[:, :-1][~alive[:, 1:]] = np.inf
        rows = np.arange(n)
        while len(rows):
            left = agenda[rows].argmin(axis=1)  # the first of equal ones
            some = agenda[rows, left] < np.inf
            rows, left = rows[some], left[some]
            if not len(rows):
                break
            right = after[rows, left]
            beyond = after[rows, right]
            symbols[rows, left] = piece[rows, left]
            alive[rows, right] = False
            agenda[rows, right] = np.inf
            agenda[rows, left] = np.inf
            after[rows, left] = beyond
            has = beyond < size[rows]
            r, x, y = rows[has], left[has], beyond[has]
            before[r, y] = x
            agenda[r, x], piece[r, x] = self._pair(symbols[r, x], symbols[r, y])
            y = before[rows, left]
            has = y >= 0
            r, x, y = rows[has], left[has], y[has]
            agenda[r, y], piece[r, y] = self._pair(symbols[r, y], symbols[r, x])
        return symbols[alive], alive.sum(axis=1)

    def _long_word(self, word: str) -> list[int]:
        symbols, score = list(word), self.score.get
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, str]] = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if (s := score(pair)) is not None:
                agenda.append((-s, i, i + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            if after[left] != right or symbols[left] + symbols[right] != pair:
                continue  # one of the two was merged since
            symbols[left], symbols[right] = pair, ""
            after[left], after[right] = after[right], -1
            if (nxt := after[left]) < n:
                before[nxt] = left
                if (s := score(pair + symbols[nxt])) is not None:
                    heapq.heappush(agenda, (-s, left, nxt, pair + symbols[nxt]))
            if (prev := before[left]) >= 0 and (s := score(symbols[prev] + pair)) is not None:
                heapq.heappush(agenda, (-s, prev, left, symbols[prev] + pair))
        return [self._symbol(s) for s in symbols if s]

    def _with_bytes(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become byte pieces."""
        odd = np.flatnonzero(symbols >= self.size)
        if not len(odd):
            return symbols, counts
        data = [self.byte_ids[np.frombuffer(chr(c).encode(), dtype=np.uint8)] for c in symbols[odd] - self.size]
        size = np.ones(len(symbols), dtype=np.int64)
        size[odd] = [len(d) for d in data]
        out = np.repeat(symbols, size)
        out[np.repeat(symbols >= self.size, size)] = np.concatenate(data)
        return out, sums(size, np.concatenate(([0], np.cumsum(counts))))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words, start and count of each)."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        order = np.argsort(size, kind="stable")
        short = order[:np.searchsorted(size[order], ROW_CHARS, side="right")]
        flats, counts = [], []
        for at in range(0, len(short), ROWS):
            some = short[at:at + ROWS]
            points = np.frombuffer("".join([words[i] for i in some]).encode("utf-32-le"), dtype="<u4")
            n = size[some]
            symbols = np.full((len(some), max(int(n[-1]), 1)), -1, dtype=np.int64)
            symbols[np.arange(symbols.shape[1]) < n[:, None]] = self.symbol_of[points]
            flat, count = self._rows(symbols, n)
            flats.append(flat)
            counts.append(count)
        for i in order[len(short):]:
            flats.append(np.array(self._long_word(words[i]), dtype=np.int64))
            counts.append(np.array([len(flats[-1])]))
        if not words:
            return (np.empty(0, dtype=np.int64),) * 3
        flat, in_order = self._with_bytes(np.concatenate(flats), np.concatenate(counts))
        starts, count = np.empty_like(size), np.empty_like(size)
        starts[order], count[order] = np.cumsum(in_order) - in_order, in_order
        return flat, starts, count

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the separator that encoding put first goes."""
        data = b"".join(map(self.surface.__getitem__, ids))
        first = next((i for i in ids if self.surface[i]), None)
        if first is not None and self.spaced[first]:
            data = data[1:]
        return data.decode("utf-8", "quaybook-one-byte")

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of lists of ids (those between neighbouring offsets)."""
        start, size = self.surface_start[ids], self.surface_size[ids]
        first = offsets[:-1][np.diff(offsets) > 0]
        if (size == 0).any():  # a control id may come first
            return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())
        first = first[self.spaced[ids[first]]]
        start[first] += 1
        size[first] -= 1
        data = gather(self.surface_bytes, start, size)
        ends = np.concatenate(([0], np.cumsum(size)))[offsets]
        texts = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data))
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:  # bytes that are no characters
            return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())
        return texts.cast(pa.string())


class AgendaEncoder:
    """Ids of texts through a bounded store of encoded pre-tokens, each
    given without its first space (which the library puts before any text)."""

    def __init__(self, model: bytes, check: bool = True):
        self.vocabulary = MergeVocabulary(model)
        self.check = check
        self.store = WordStore(self._new_words)

    def _new_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat, starts, counts = self.vocabulary.encode_words([SEPARATOR + w.replace(" ", SEPARATOR) for w in words])
        if self.check:  # the lone separator is no text of its own for the library
            theirs = self.vocabulary.processor.encode(words, num_threads=1)
            theirs = [ids if w else [self.vocabulary.ids[SEPARATOR]] for w, ids in zip(words, theirs, strict=True)]
            if not np.array_equal(gather(flat, starts, counts), np.fromiter(chain.from_iterable(theirs), dtype=np.int64)):
                bad = next(w for w, s, n, ids in zip(words, starts, counts, theirs, strict=True) if flat[s:s + n].tolist() != ids)
                raise ValueError(f"pieces of {bad[:80]!r} differ from the library's")
        return flat, starts, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each)."""
        offsets, codes, words = coded_pre_tokens(texts)
        ids, counts = self.store.numbers(self.store.slots(words)[codes])
        return ids, np.concatenate(([0], np.cumsum(sums(counts, offsets))))

    def encode_long(self, text: str) -> np.ndarray:
        """Block by block; a block ends before a run of spaces."""
        parts, at = [], 0
        text = text.replace(SEPARATOR, " ")
        while at < len(text):
            end = at + BLOCK_BYTES
            while 0 <= (end := text.find(" ", end)) and text[end - 1] == " ":
                end += 1
            end = len(text) if end < 0 else end
            # The space at a later block's start is the one its first
            # pre-token is given without.
            block = text[at if at == 0 else at + 1:end]
            parts.append(self.encode(pa.array([block]))[0] if block else self.store.numbers(self.store.slots([""]))[0])
            at = end
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)

    def encode_batch(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, offsets) of blocks of a batch; a text longer
        than a block comes alone."""
        for a, b, long in text_blocks(texts, BLOCK_BYTES):
            if long:
                ids = self.encode_long(texts[a].as_py())
                yield a, b, ids, np.array([0, len(ids)])
            else:
                yield a, b, *self.encode(texts[a:b])


_ENCODERS: dict[tuple[int, bool], AgendaEncoder] = {}


def _encoder(model: bytes, check: bool = True) -> AgendaEncoder:
    """One per worker process, kept from task to task."""
    key = (hash(model), check)
    if key not in _ENCODERS:
        _ENCODERS[key] = AgendaEncoder(model, check)
    return _ENCODERS[key]


def encode_texts(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                 check: bool = True) -> DataFrame:
    """(doc_id, ids, decoded) of every row: the ids of the whole text and the
    text decoded from them. ``model`` is the content of a model file (a
    vocabulary, so of bounded size). ``check``: compare each Arrow batch's new
    pre-tokens with the library."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, doc_text=text_col)
    id_type = rows.schema["doc_id"].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model, check)
        for batch in batches:
            for a, b, ids, offsets in encoder.encode_batch(batch.column(1)):
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], lists, encoder.vocabulary.decode_all(ids, offsets)],
                                                 names=["doc_id", "ids", "decoded"])

    return rows.mapInArrow(encode, f"doc_id {id_type.simpleString()}, ids array<int>, decoded string")


def decode_ids(encoded: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows of piece ids, null ids left out."""
    prepare(encoded.sparkSession)
    rows = pick(encoded, doc_id=id_col, ids=ids_col).withColumn(
        "ids", F.coalesce(F.array_compact(F.col("ids").cast("array<int>")), F.array().cast("array<int>")))
    id_type = rows.schema["doc_id"].dataType

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _encoder(model).vocabulary
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.flatten().to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), vocabulary.decode_all(ids, offsets - offsets[0])],
                                             names=["doc_id", "text"])

    return rows.mapInArrow(decode, f"doc_id {id_type.simpleString()}, text string")


def audit(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, same_ids, same_text) of every row: whether the whole text's
    ids, and the text decoded from them, are those of the library."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, doc_text=text_col)
    id_type = rows.schema["doc_id"].dataType
    arrow_id = to_arrow_type(id_type)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model, False)
        library = encoder.vocabulary.processor
        for batch in batches:
            for a, b, ids, offsets in encoder.encode_batch(batch.column(1)):
                theirs = library.encode([t or "" for t in batch.column(1)[a:b].to_pylist()], num_threads=1)
                texts = encoder.vocabulary.decode_all(ids, offsets).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[a:b].cast(arrow_id),
                    pa.array([ids[s:e].tolist() == t for s, e, t in zip(offsets[:-1], offsets[1:], theirs, strict=True)], pa.bool_()),
                    pa.array([x == library.decode(t) for x, t in zip(texts, theirs, strict=True)], pa.bool_())],
                    names=["doc_id", "same_ids", "same_text"])

    return rows.mapInArrow(compare, f"doc_id {id_type.simpleString()}, same_ids boolean, same_text boolean")
