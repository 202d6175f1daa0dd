"""Token counts against the library on whole texts."""
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from quaybook.llm import segments, token_counts
from quaybook.llm.queries import op7_token_counts
from quaybook.sources.tables import read_table

SF001 = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = open(PATH, "rb").read()
ODD = ["", None, " ", "  ", "a", " a", "a ", "a  b", "   a   b   ", "\n", "a\n b", "x▁y ▁▁ z", "<s> a</s> <unk>",
       "é日本 語\t\tz", "  ", "<0x0A>", "word " * 5000, "z" * 9000, "▁", " ▁ "]


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_whole_table(spark, processor):
    want = {(r.doc_id, len(r.text.encode()), len(processor.encode(r.text)), len(processor.encode(r.text)) > 4096)
            for r in read_table(spark, SF001, "documents").collect()}
    assert {tuple(r) for r in op7_token_counts(spark, SF001).collect()} == want


def test_odd_texts(spark, processor):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(df, MODEL).collect()}
    assert got == {i: (len((t or "").encode()), len(processor.encode(t or ""))) for i, t in enumerate(ODD)}


def test_blocks_and_generations(monkeypatch, processor):
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", 15)
    monkeypatch.setattr(segments, "MAX_WORDS", 5)
    counter = token_counts.PieceCounter(MODEL)
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["ab", " ", "  ", "\n", "thing ", "é", "▁", ".", "The"]) for _ in range(50))
        assert counter.of_long_text(text) == len(processor.encode(text)), text
        assert counter.of_texts(pa.array([text, None, text])).tolist() == [n := len(processor.encode(text)), 0, n], text


def test_empty_repeated_null_and_extra_columns(spark):
    assert token_counts.count_tokens(spark.createDataFrame([], "doc_id long, text string"), MODEL).collect() == []
    df = spark.createDataFrame([(1, "a b", 7), (1, "a b", 7), (None, "c", 7)], "doc_id long, text string, n_bytes long")
    rows = token_counts.count_tokens(df, MODEL, limit=1).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.over_limit) for r in rows) == [("1", 2, True), ("1", 2, True), ("None", 1, False)]
