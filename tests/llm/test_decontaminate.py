"""Winnowing against brute force over all windows."""
import random
import re

import pytest

from quaybook.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, item_text in items:
            b = words(item_text)
            n = min(window, len(b))
            wins = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if b else set()
            for i in range(len(w) - n + 1) if b else ():
                if tuple(w[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = D.document_hits(d, b).drop("text_key").collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in rows), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "C", "é", "d9", "Zz"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))

    items = [(i, text(rng.choice([1, 5, 12, 13, 14, 20, 30]))) for i in range(10)] + [(90, None), (91, ""), (92, "...")]
    items += [(20, items[0][1]), (3, "x"), (3, items[4][1])]
    docs = [(i, text(rng.randint(0, 60))) for i in range(30)]
    docs += [(100 + i, text(15) + " " + items[i % 10][1] + " " + text(300)) for i in range(30)]
    docs += [(200, None), (201, ""), (None, items[5][1]), docs[3], docs[3], (202, "same " * 40)]
    items.append((93, "same " * 16))
    assert run(spark, docs, items) == brute(docs, items)


def test_only_long_items_and_no_items(spark):
    rng = random.Random(5)
    item = " ".join(rng.choice("abcdefgh") for _ in range(40))
    docs = [(1, "x " + " ".join(item.split()[10:23]) + " y"), (2, " ".join(item.split()[10:22])), (3, "p " * 300 + item)]
    assert run(spark, docs, [(7, item)]) == brute(docs, [(7, item)])
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], [(7, item)]) == []


def test_clean_documents_keeps_columns(spark):
    item = " ".join("abcdefghijklmnop")
    d = spark.createDataFrame([(1, item, 3), (2, "fine words", 4), (2, "fine words", 4), (None, None, 5)],
                              "doc_id long, text string, words long")
    b = spark.createDataFrame([(7, item)], "item_id long, text string")
    kept = D.clean_documents(d, b)
    assert kept.columns == d.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, [r for r in d.collect() if r.doc_id != 1]))


def test_repeated_words_take_time_in_proportion(spark):
    """One word 20,000 times against an item that has it 500 times."""
    import time
    docs = spark.createDataFrame([(1, "again " * 20_000), (2, "again " * 12), (3, "x " + "again " * 13)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "again " * 500)], "item_id long, text string")
    D.document_hits(docs.where("doc_id = 2"), items).collect()  # start of the session's workers
    began = time.time()
    got = {r.doc_id: r.n_hit for r in D.document_hits(docs, items).collect()}
    took = time.time() - began
    assert got == {1: 20_000, 2: 0, 3: 13} and took < 30, (got, took)
