import random
from pathlib import Path

import pyarrow as pa
import pytest

from quaybook.llm import piece_agenda, segments

SCHEMA = "doc_id long, text string, ids string"


@pytest.fixture(scope="module")
def model():
    import public_tokenizers
    return Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()


@pytest.fixture(scope="module")
def library(model):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=model)


ODD = [None, "", " ", "  ", "a", " a", "a ", "  a  b ", "a\tb\nc\r\n\n d", "héllo 你好 \U0001f600 ﬁ Á", "▁x▁", " ▁ a", "▁",
       "<s> </s> <unk> <0x41> <pad>", "\x00a\x00", "á", "x" * 5000, " " * 300 + "y" + " " * 47, "0123456789 3.14",
       "한국어 مرحبا שלום ไทย", "﷽ ￿   \xa0z", "tie aaaa aaaaa aaaaaa"]


def test_odd_texts(spark, model, library):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(None, "null id", "x"), (1, "", "again"), (1, "again", "x")]
    got = piece_agenda.encode_texts(spark.createDataFrame(rows, SCHEMA), model).collect()
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, _ in rows]
    assert sorted(map(repr, [(r.doc_id, r.ids, r.decoded) for r in got])) == sorted(map(repr, want))


def test_random_words(model, library):
    vocabulary = piece_agenda.MergeVocabulary(model)
    rng = random.Random(5)
    letters = "aeinorst" * 4 + "bcdfghklmpuvwxyz" + "ABC012.,'-\n\té你ß"
    words = []
    for _ in range(3000):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))
        words.append(word)
    flat, starts, counts = vocabulary.encode_words(["▁" + w for w in words])
    for word, a, n in zip(words, starts, counts):
        ids = flat[a:a + n].tolist()
        assert ids == library.encode(word), word
        assert vocabulary.decode(ids) == library.decode(ids)


def test_whole_table(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = piece_agenda.audit(docs, model).groupBy("same_ids", "same_text").count().collect()
    assert [(r.same_ids, r.same_text, r["count"]) for r in found] == [(True, True, docs.count())]


def test_long_text_in_blocks(spark, model, library, monkeypatch):
    monkeypatch.setattr(piece_agenda, "BLOCK_BYTES", 64)
    monkeypatch.setattr(segments, "MAX_WORDS", 10)
    encoder = piece_agenda.AgendaEncoder(model)
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice(["word", " ", "  ", "▁", "x" * 70, "\n", "é"]) for _ in range(80))
        assert encoder.encode_long(text).tolist() == library.encode(text)


def test_decode_any_ids(spark, model, library):
    rng = random.Random(8)
    lists = [[rng.randrange(32000) for _ in range(rng.randint(0, 30))] for _ in range(300)]
    lists += [[rng.randrange(3, 259) for _ in range(9)] for _ in range(300)] + [[1, 264], [0], [2], []]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lists)] + [(-1, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in piece_agenda.decode_ids(rows, model).collect()}
    assert got.pop(-1) == ""
    assert all(got[i] == library.decode(x) for i, x in enumerate(lists) if 1 not in x[:1])


def test_difference_from_library_fails(model):
    encoder = piece_agenda.AgendaEncoder(model)
    encoder.vocabulary.pair_cost[:] = float("inf")  # no merges
    with pytest.raises(ValueError, match="differ"):
        encoder.encode(pa.array(["some words together"]))


def test_empty(spark, model):
    assert piece_agenda.encode_texts(spark.createDataFrame([], SCHEMA), model).collect() == []
    assert piece_agenda.audit(spark.createDataFrame([], SCHEMA), model).collect() == []


def test_query_digests(spark, library):
    from hashlib import sha256

    from quaybook.llm.queries import op13_merge_agenda
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = op13_merge_agenda(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256(library.decode(ids).encode()).hexdigest()
