"""Cost-balanced packing of documents into token sequences.

Each input split is tokenised and packed where it lies: there is no shuffle,
no group and nothing on the driver. Documents are gathered into cells of at
most ``cell_tokens`` tokens (bounded memory, a parameter), and each cell is
packed by itself:

1. A document is its ids and then ``end_id``. Whole lengths of ``seq_len``
   are cut off; each fills a sequence of its own.
2. The cell's sequences are fixed by its token total T: T // seq_len full
   ones, and the powers of two that add up to the rest. So every sequence is
   filled and none needs padding (a sequence whose length is a power of two
   is not padded).
3. A piece of n tokens costs ``linear * n + quadratic * n**2`` (projections
   and attention). In descending order each piece goes to the sequence of
   the lowest cost so far that still has room for it. A piece for which no
   sequence has room is cut to the largest room left, and its rest queues.

Ids come from the ``tokenizers`` library. As a byte-level pre-token never
spans the place before a space that a non-space follows, a text is the
concatenation of its space-led segments; Arrow numbers a batch's segments, a
task encodes those that are new to it, many in one call, and texts are
gathered from a bounded store (``segments``). Texts with irregular white space
are encoded whole, so ids always equal those of the whole text. If the
tokenizer is a plain byte-level BPE whose merges stand in the order of their
ids, new segments of Latin letters go through ``tiktoken`` with the ranks of
that same file, which merges alike and several times faster.

Null or empty texts have one token (``end_id``). Repeated rows are packed as
rows of their own. Rows keep their ids, null ones included. An empty input
gives no pieces.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quaybook.llm.common import pick, prepare, release_memory
from quaybook.llm.segments import WordStore, gather, split_at_spaces, sums, text_blocks

SEQ_LEN = 1024
CELL_TOKENS = 1 << 22
BLOCK_BYTES = 1 << 21  # texts are split into segments this much at a time
ENCODE_AT_ONCE = 2_000  # segments in one call of the library
PIECES_AT_ONCE = 512  # in an Arrow batch: at most 2 MB of ids with sequences of 1024
PARTITION_BITS = 36
SPACE = "Ġ"  # how the vocabulary writes a space
# Fixed value: how byte-level vocabularies cut texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LATIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\u024f]*\Z").match  # the libraries class these alike

PIECES = ("doc_id {id}, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long, cost double")


def merge_ranks(tokenizer_json: str):
    """The ``tiktoken`` encoding that merges as the tokenizer does, or None if
    it is of another kind."""
    import tiktoken

    given = json.loads(tokenizer_json)
    model, before = given["model"], given.get("pre_tokenizer") or {}
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                           "byte_fallback", "ignore_merges"))
    if not (plain and model.get("type") == "BPE" and given.get("normalizer") is None and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space") and before.get("use_regex")):
        return None
    # Byte-level vocabularies write visible bytes as themselves and the others from 256 on.
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = {t["content"]: t["id"] for t in given.get("added_tokens", ())}
    made = [model["vocab"][a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    if made != sorted(made) or len(ranks) != 256 + len(made) or any(ranks.get(bytes([b]), made[0]) >= made[0] for b in range(256)):
        return None
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)


class SegmentEncoder:
    """Ids of texts through a bounded store of segments. A segment is a text's
    first word, or a space and a later word."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.space_led = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.space_led[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        self.ranks = merge_ranks(tokenizer_json)
        self.store = WordStore(self._segments)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, dtype=np.int32)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_ranks(self, text: str) -> np.ndarray:
        return np.asarray(self.ranks.encode(text, allowed_special="all"), dtype=np.int32)

    def _segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(all ids, start and count of each segment). Space-led segments are
        encoded as one text and cut where an id begins with a space."""
        led = np.array([s[:1] == " " for s in segments])
        latin = led & np.array([self.ranks is not None and LATIN(s) is not None for s in segments])
        order, flats, counts = [], [], []
        for kind, encode in ((latin, self._by_ranks), (led & ~latin, lambda text: self._encode([text])[0])):
            spaced = np.flatnonzero(kind)
            for at in range(0, len(spaced), ENCODE_AT_ONCE):
                some = spaced[at:at + ENCODE_AT_ONCE]
                ids = encode("".join([segments[i] for i in some]))
                cuts = np.flatnonzero(self.space_led[ids])
                if len(cuts) != len(some) or cuts[0]:
                    raise ValueError("a space stands inside a segment")
                order.append(some)
                flats.append(ids)
                counts.append(np.diff(np.append(cuts, len(ids))))
        order.append(np.flatnonzero(~led))
        firsts = self._encode([segments[i] for i in order[-1]])
        counts.append(np.array([len(f) for f in firsts], dtype=np.int64))
        order, count = np.concatenate(order), np.concatenate(counts)
        starts, n = np.empty(len(segments), dtype=np.int64), np.empty(len(segments), dtype=np.int64)
        starts[order], n[order] = np.cumsum(count) - count, count
        return np.concatenate([*flats, *firsts]) if len(segments) else np.empty(0, dtype=np.int32), starts, n

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has)."""
        offsets, codes, words = split_at_spaces(texts)
        later = np.ones(len(codes), dtype=bool)
        later[offsets[:-1]] = False
        # Before an empty segment or one that starts with white space, a
        # pre-token may span the border: such texts are encoded whole.
        odd = np.array([not w or w[0].isspace() for w in words])
        whole = sums(odd[codes] & later, offsets) > 0
        if whole.any():
            keep = np.repeat(~whole, np.diff(offsets))
            codes, later = codes[keep], later[keep]
            offsets = np.concatenate(([0], np.cumsum(np.where(whole, 0, np.diff(offsets)))))
        n = len(words)
        place = codes + np.where(later, 0, n)
        used = np.flatnonzero(np.bincount(place, minlength=2 * n))
        slots = np.empty(2 * n, dtype=np.int64)
        slots[used] = self.store.slots([" " + words[i] if i < n else words[i - n] for i in used.tolist()])
        ids, counts = self.store.numbers(slots[place])
        counts = sums(counts, offsets)
        if whole.any():
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i in np.flatnonzero(whole).tolist():  # the library's own result of a text is large
                parts[i] = self._encode([texts[i].as_py()])[0]
                counts[i] = len(parts[i])
            ids = np.concatenate(parts)
        return ids, counts

    def long_text(self, text: str) -> np.ndarray:
        """A text of any length, block by block. A block ends before a space
        that a non-space follows."""
        parts, at = [], 0
        before = len(self.encode(pa.array(["x"]))[0])
        while at < len(text):
            end = at + BLOCK_BYTES
            while 0 <= (end := text.find(" ", end)) < len(text) - 1 and text[end + 1].isspace():
                end += 1
            end = len(text) if end < 0 else end
            block = text[at:end]
            # All blocks but the first start with the space of their first segment.
            parts.append(self.encode(pa.array([block if at == 0 else "x" + block]))[0][0 if at == 0 else before:])
            at = end
        return np.concatenate(parts)


def _room_tree(seq_len: int):
    """Sequences by the room they have left; the lowest cost among those with
    room for n tokens is found in log2(seq_len) steps."""
    size = 1 << seq_len.bit_length()
    best = [(float("inf"), -1)] * (2 * size)
    heaps: list[list] = [[] for _ in range(size)]

    def refresh(room: int) -> None:
        i = room + size
        best[i] = heaps[room][0] if heaps[room] else (float("inf"), -1)
        while i > 1:
            i >>= 1
            a, b = best[2 * i], best[2 * i + 1]
            best[i] = a if a <= b else b

    def put(room: int, cost: float, seq: int) -> None:
        heapq.heappush(heaps[room], (cost, seq))
        if heaps[room][0] == (cost, seq):
            refresh(room)

    def take(n: int) -> int:
        """The sequence of the lowest cost with room for n, or -1."""
        lo, hi, found = n + size, 2 * size - 1, (float("inf"), -1)
        while lo <= hi:
            if lo & 1:
                found, lo = min(found, best[lo]), lo + 1
            if not hi & 1:
                found, hi = min(found, best[hi]), hi - 1
            lo, hi = lo >> 1, hi >> 1
        return found[1]

    def drop(room: int) -> None:
        heapq.heappop(heaps[room])
        refresh(room)

    def widest() -> int:
        """The largest room that any sequence has left."""
        i = 1
        while i < size:
            i = 2 * i + 1 if best[2 * i + 1][1] >= 0 else 2 * i
        return i - size

    return put, take, drop, widest


def pack_lengths(lengths: list[int], seq_len: int, linear: float = 1.0,
                 quadratic: float = 1.0 / SEQ_LEN) -> tuple[list[tuple], list[int], list[float]]:
    """Pieces (document, start, length, sequence, offset) of one cell, the
    sequences' lengths and their costs."""
    total = sum(lengths)
    capacity = [seq_len] * (total // seq_len)
    rest = total % seq_len
    while rest:
        capacity.append(1 << (rest.bit_length() - 1))
        rest -= capacity[-1]
    price = [linear * n + quadratic * n * n for n in range(seq_len + 1)]
    cost, room, pieces, queue = [0.0] * len(capacity), list(capacity), [], []
    full = 0
    for doc, n in enumerate(lengths):
        for k in range(n // seq_len):  # longest pieces: each takes an empty sequence
            pieces.append((doc, k * seq_len, seq_len, full, 0))
            cost[full], room[full] = price[seq_len], 0
            full += 1
        if n % seq_len:
            queue.append((-(n % seq_len), doc, n - n % seq_len))
    put, take, drop, widest = _room_tree(seq_len)
    for seq in range(full, len(capacity)):
        put(room[seq], 0.0, seq)
    heapq.heapify(queue)
    while queue:
        n, doc, start = heapq.heappop(queue)
        n, fits = -n, -n
        if (seq := take(n)) < 0:
            fits = widest()
            seq = take(fits)
            heapq.heappush(queue, (fits - n, doc, start + fits))
        drop(room[seq])
        pieces.append((doc, start, fits, seq, capacity[seq] - room[seq]))
        cost[seq] += price[fits]
        room[seq] -= fits
        if room[seq]:
            put(room[seq], cost[seq], seq)
    return pieces, capacity, cost


_ENCODERS: dict[int, SegmentEncoder] = {}


def _encoder(tokenizer_json: str) -> SegmentEncoder:
    """One per worker process, kept from task to task; its store is emptied
    when a task ends."""
    key = hash(tokenizer_json)
    if key not in _ENCODERS:
        _ENCODERS[key] = SegmentEncoder(tokenizer_json)
    return _ENCODERS[key]


def _with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """The ids of texts with ``end_id`` behind each."""
    out = np.full(len(ids) + len(counts), end_id, dtype="<u4")
    out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return out


def _cells(batches: Iterator[pa.RecordBatch], encoder: SegmentEncoder, end_id: int,
           cell_tokens: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids of documents, their tokens, how many each has) of one cell after
    the other."""
    docs, tokens, lengths, held = [], [], [], 0
    for batch in batches:
        for a, b, long in text_blocks(batch.column(1), BLOCK_BYTES):
            texts = batch.column(1)[a:b]
            if long:
                ids = encoder.long_text(texts[0].as_py())
                counts = np.array([len(ids)])
            else:
                ids, counts = encoder.encode(texts)
            docs.append(batch.column(0)[a:b])
            tokens.append(_with_end(ids, counts, end_id))
            lengths.append(counts + 1)
            held += len(tokens[-1])
            if held >= cell_tokens:
                cell = pa.concat_arrays(docs), np.concatenate(tokens), np.concatenate(lengths)
                docs, tokens, lengths, held = [], [], [], 0  # before the cell is packed, so it is held once
                yield cell
                del cell
    if docs:
        yield pa.concat_arrays(docs), np.concatenate(tokens), np.concatenate(lengths)


def pack_documents(docs: DataFrame, tokenizer_json: str, seq_len: int = SEQ_LEN, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text", linear: float = 1.0,
                   quadratic: float = 1.0 / SEQ_LEN, cell_tokens: int = CELL_TOKENS) -> DataFrame:
    """One row per piece: its document, its place there and in its sequence,
    and its ids (little-endian 32-bit). ``tokenizer_json`` is the text of a
    tokenizer file (a vocabulary, so of bounded size)."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, doc_text=text_col)
    shape = PIECES.format(id=rows.schema["doc_id"].dataType.simpleString())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_json)
        try:
            yield from packed(batches, encoder)
        finally:
            # The worker stays for stages that don't pack.
            encoder.store.clear()
            release_memory()

    def packed(batches: Iterator[pa.RecordBatch], encoder: SegmentEncoder) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << PARTITION_BITS
        for cell, tokens, lengths in _cells(batches, encoder, end_id, cell_tokens):
            pieces, capacity, cost = pack_lengths(lengths.tolist(), seq_len, linear, quadratic)
            pieces, capacity, cost = np.array(pieces, dtype=np.int64), np.array(capacity, dtype=np.int64), np.array(cost)
            doc_starts = np.cumsum(lengths) - lengths
            for at in range(0, len(pieces), PIECES_AT_ONCE):
                doc, start, length, seq, offset = pieces[at:at + PIECES_AT_ONCE].T
                ends = np.concatenate(([0], 4 * np.cumsum(length))).astype(np.int32)
                ids = gather(tokens, doc_starts[doc] + start, length)
                yield pa.RecordBatch.from_arrays([
                    cell.take(pa.array(doc)), pa.array(start), pa.array(length),
                    pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(ids)]),
                    pa.array(lengths[doc]), pa.array(first + seq), pa.array(offset), pa.array(capacity[seq]),
                    pa.array(cost[seq])],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id",
                           "offset", "sequence_tokens", "cost"])
            first += len(capacity)
            release_memory()

    return rows.mapInArrow(pack, shape)
