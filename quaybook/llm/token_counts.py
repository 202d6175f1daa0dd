"""Token counts of whole texts from the counts of distinct pre-tokens.

The model's pieces never hold a word separator behind another character, so
a text falls into pre-tokens (a run of spaces and the non-spaces behind it)
whose pieces don't depend on each other. Each Arrow batch is cut into blocks
of bounded text, and a block into rows (document, pre-token, frequency). The
pieces of each pre-token that is new to the worker are counted once, these
counts are joined to the block's rows, and count times frequency is summed for
each document. Ids are never kept, nothing is shuffled and no key is gathered
in one place, so skewed sources or copies make no difference.

How often a pre-token is counted: once in each worker that meets it, and once
more whenever the worker's store of known counts outgrew its bound
(``segments.MAX_WORDS``) in between. Counting it once in the whole cluster
would move most of the corpus through a shuffle.

``check_splittable`` proves the assumption on the vocabulary itself; a model
that breaks it is refused.

Null and empty texts have 0 tokens and 0 bytes. Repeated rows are counted
one by one; null ids are kept; an empty input gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from quaybook.llm.common import pick, prepare
from quaybook.llm.segments import WordStore, split_at_spaces, sums, text_blocks

LIMIT = 4096
SEPARATOR = "▁"  # how the library writes a space inside pieces
BLOCK_BYTES = 1 << 21
ENCODE_AT_ONCE = 20_000

_RUNS = re.compile(r" *[^ ]+| +")


def check_splittable(processor) -> None:
    """Raise unless texts may be cut before each run of spaces."""
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if not processor.is_control(i) and SEPARATOR in piece.lstrip(SEPARATOR):
            raise ValueError(f"piece {piece!r} spans a word border")
    if processor.encode("a  b", out_type=str) != processor.encode("a", out_type=str) + [
            SEPARATOR] + processor.encode("b", out_type=str):
        raise ValueError("the model rewrites white space")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, each without its first space: the text's
    own first one gets its space from the library."""
    if not text:
        return []
    if SEPARATOR in text:  # the library takes it for a space
        text = text.replace(SEPARATOR, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [run[1:] if run[0] == " " else run for run in _RUNS.findall(" " + text)]


def coded_pre_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(offsets of the texts' pre-tokens, their codes, the distinct ones).
    Texts whose spaces stand alone between words are split by Arrow, the
    others one by one."""
    offsets, codes, words = split_at_spaces(texts)
    plain = np.array([bool(w) and SEPARATOR not in w for w in words])
    odd = np.flatnonzero(sums(~plain[codes], offsets))
    if not len(odd):
        return offsets, codes, words
    runs = [pre_tokens(texts[int(i)].as_py() or "") for i in odd]
    parts = np.split(codes, offsets[1:-1])
    place = {words[c]: c for c in np.unique(np.concatenate([codes[:0]] + [parts[i] for i in np.setdiff1d(np.arange(len(parts)), odd)]))}
    found = {w: i for i, w in enumerate(dict.fromkeys(chain(place, chain.from_iterable(runs))))}
    moved = np.zeros(len(words), dtype=np.int64)
    moved[list(place.values())] = [found[w] for w in place]
    parts = [moved[p] for p in parts]
    for i, run in zip(odd, runs, strict=True):
        parts[i] = np.array([found[w] for w in run], dtype=np.int64)
    return np.concatenate(([0], np.cumsum([len(p) for p in parts]))), np.concatenate(parts), list(found)


class PieceCounter:
    """Numbers of pieces of texts, through counts of distinct pre-tokens."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        check_splittable(self.processor)
        self.store = WordStore(self._counted)

    def _counted(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of each pre-token, given without its first space (which the
        library puts before any text). An empty one is a space alone."""
        n = [max(len(x), 1) for at in range(0, len(words), ENCODE_AT_ONCE)
             for x in self.processor.encode(words[at:at + ENCODE_AT_ONCE], num_threads=1)]
        return np.empty(0, dtype=np.int32), np.zeros(len(n), dtype=np.int64), np.array(n, dtype=np.int64)

    def of_texts(self, texts: pa.Array) -> np.ndarray:
        offsets, codes, words = coded_pre_tokens(texts)
        slots = self.store.slots(words)
        counts = self.store.counts[slots]
        # Rows (document, pre-token, frequency), joined to the counts.
        rows = np.repeat(np.arange(len(texts)), np.diff(offsets)) * max(len(words), 1) + codes
        rows, frequency = np.unique(rows, return_counts=True)
        document, word = np.divmod(rows, max(len(words), 1))
        return np.bincount(document, weights=counts[word] * frequency, minlength=len(texts)).astype(np.int64)

    def of_long_text(self, text: str) -> int:
        """Block by block; a block ends before a run of spaces."""
        total, at = 0, 0
        while at < len(text):
            end = at + BLOCK_BYTES
            while 0 <= (end := text.find(" ", end)) and text[end - 1] in (" ", SEPARATOR):
                end += 1
            end = len(text) if end < 0 else end
            # The space at a later block's start is the one the library adds;
            # a block that is this space alone counts as one piece.
            block = text[at if at == 0 else at + 1:end]
            total += int(self.of_texts(pa.array([block]))[0]) if block else 1
            at = end
        return total

    def of_batch(self, texts: pa.Array) -> np.ndarray:
        parts = [np.array([self.of_long_text(texts[a].as_py())]) if long else self.of_texts(texts[a:b])
                 for a, b, long in text_blocks(texts, BLOCK_BYTES)]
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


_COUNTERS: dict[int, PieceCounter] = {}


def _counter(model: bytes) -> PieceCounter:
    """One per worker process, kept from task to task."""
    key = hash(model)
    if key not in _COUNTERS:
        _COUNTERS[key] = PieceCounter(model)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, model: bytes, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row. ``model`` is the
    content of a model file (a vocabulary, so of bounded size)."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, doc_text=text_col)
    id_type = rows.schema["doc_id"].dataType
    arrow_id = to_arrow_type(id_type)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model)
        for batch in batches:
            texts = batch.column(1)
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            n_tokens = pa.array(counter.of_batch(texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_id), n_bytes, n_tokens, pc.greater(n_tokens, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(
        count, f"doc_id {id_type.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
