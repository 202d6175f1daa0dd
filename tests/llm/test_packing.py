"""Packing: ids against the tokenizer on whole texts, and every sequence full."""
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quaybook.llm import packing
from quaybook.llm.queries import op1_cost_packing, packed_digest, packing_tokenizer
from quaybook.sources.tables import read_table

SF001 = "/root/testdata/sf0.001"
ODD = ["", None, " ", "a", "  a", "a  b", "a   b ", "a \n b", "a\n\n \nb", "x <|endoftext|> y<|endoftext|>",
       "it's 's  'll", " x　 y", "日本 語", "a\tb \tc", "word " * 5000, "z" * 9000, "a\n b\n  c"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, texts, tokenizer, seq_len=1024):
    """rows: the pieces; texts: (doc_id, text) of distinct ids."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == {d for d, _ in texts}
    for d, text in texts:
        ids = np.asarray(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= seq_len and (at == seq_len or at & (at - 1) == 0)


def test_whole_table(spark, tokenizer):
    docs = read_table(spark, SF001, "documents").select("doc_id", "text").collect()
    check(op1_cost_packing(spark, SF001).collect(), [(r.doc_id, r.text) for r in docs], tokenizer)


def test_odd_texts(spark, tokenizer):
    texts = list(enumerate(ODD))
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    check(packed_digest(df).collect(), texts, tokenizer)


def test_blocks_of_long_texts(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "BLOCK_BYTES", 20)
    encoder = packing.SegmentEncoder(packing_tokenizer())
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["ab", " ", "  ", "\n", "thing ", "é", "'s ", " \n"]) for _ in range(60))
        got = encoder.long_text(text).tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_empty_repeated_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packed_digest(empty).collect() == []
    df = spark.createDataFrame([(1, "a b", 5, 9), (1, "a b", 5, 9), (None, "c", 5, 9)],
                               "doc_id long, text string, ids long, offset long")
    rows = packed_digest(df).collect()
    assert sorted((str(r.doc_id), r.doc_tokens) for r in rows if r.start == 0) == [("1", 3), ("1", 3), ("None", 2)]


def test_lowest_cost_with_room():
    rng = random.Random(2)
    for _ in range(50):
        lengths = [rng.randint(1, 200) for _ in range(rng.randint(1, 120))]
        pieces, capacity, cost = packing.pack_lengths(lengths, 64)
        assert sum(p[2] for p in pieces) == sum(lengths) == sum(capacity)
        fill = defaultdict(int)
        for _, _, n, seq, offset in pieces:
            assert offset == fill[seq]
            fill[seq] += n
        assert all(fill[s] == c for s, c in enumerate(capacity))
    even, _, cost = packing.pack_lengths([32] * 8 + [16] * 16, 64)
    assert max(cost) - min(cost) < 0.5 * max(cost)


def plain_greedy(lengths, seq_len, linear=1.0, quadratic=1 / 1024):
    """The packing rule over lists: descending pieces, each to the cheapest
    sequence with room, cut to the widest room if none has."""
    total = sum(lengths)
    room = [seq_len] * (total // seq_len) + [1 << b for b in range(seq_len.bit_length(), -1, -1) if (total % seq_len) >> b & 1]
    cost, fill = [0.0] * len(room), [0] * len(room)
    pieces, queue = [], []
    for doc, n in enumerate(lengths):
        queue += [(-min(seq_len, n - at), doc, at) for at in range(0, n, seq_len)]
    while queue:
        queue.sort()
        n, doc, start = queue.pop(0)
        n = -n
        fits = [s for s in range(len(room)) if room[s] >= n]
        take = n if fits else max(room)
        seq = min((s for s in range(len(room)) if room[s] >= take), key=lambda s: (cost[s], s))
        if take < n:
            queue.append((take - n, doc, start + take))
        pieces.append((doc, start, take, seq, fill[seq]))
        fill[seq] += take
        room[seq] -= take
        cost[seq] += linear * take + quadratic * take * take
    return pieces


def test_greedy_rule():
    rng = random.Random(7)
    for _ in range(120):
        seq_len = rng.choice([8, 16, 64])
        lengths = [rng.choice([rng.randint(1, 10), rng.randint(1, 3 * seq_len)]) for _ in range(rng.randint(0, 40))]
        assert sorted(packing.pack_lengths(lengths, seq_len)[0]) == sorted(plain_greedy(lengths, seq_len))


def test_merge_ranks(tokenizer):
    encoder = packing.SegmentEncoder(packing_tokenizer())
    rng = random.Random(11)
    letters = "etaoinshrdlu" * 3 + "ABCXYZ0123456789.,;:!?'\"()-_/\\\n\t\r\u00e9\u00df\u00f1\u0142\u0159\u00ab\u00bb\u00bd\u00b2\u00aa\u4e2d\u6587\u05d0"
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 12))).strip() for _ in range(20_000)} - {""})
    words += ["<|endoftext|>", "a<|endoftext|>b", "it's", "WE'LL", "'s", "\U0001f600x"]
    flat, starts, counts = encoder._segments([" " + w for w in words])
    for w, a, n in zip(words, starts, counts):
        assert flat[a:a + n].tolist() == tokenizer.encode(" " + w, add_special_tokens=False).ids, w
    assert packing.merge_ranks(packing_tokenizer().replace('"use_regex":true', '"use_regex":false')) is None or '"use_regex":true' not in packing_tokenizer()


def test_workers_forget_words_after_their_task(spark):
    """Workers stay for later stages: what packing has learned is gone by then."""
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(500))) for i in range(40)], "doc_id long, text string")
    assert packing.pack_documents(docs, packing_tokenizer()).count()

    def held(batches):
        import os
        import time

        import pyarrow as pa

        from quaybook.llm import packing as own
        for _ in batches:
            pass
        time.sleep(0.2)  # so that every idle worker gets a task
        for e in own._ENCODERS.values():
            yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "words": [len(e.store.place)]})

    n = spark.sparkContext.defaultParallelism
    found = spark.range(0, 4 * n, 1, 4 * n).mapInArrow(held, "pid long, words long").collect()
    assert found and not any(r.words for r in found)
