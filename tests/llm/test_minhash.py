"""Near duplicates against brute force over all pairs; the sketch's properties."""
import random
import re

import numpy as np

from quaybook.llm import minhash as M
from quaybook.llm.queries import op5_similarity_sketching
from quaybook.sources.tables import read_table

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(w) < 5:
        return {tuple(w)}
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(docs):
    """docs: (id, text); ids may repeat. -> (id, size, component)"""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    seen = set()
    for same in where.values():
        for i in same:
            for j in same:
                if i < j and find(i) != find(j) and (i, j) not in seen:
                    seen.add((i, j))
                    common = len(sets[i] & sets[j])
                    if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                        root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(docs)), key=str)


def run(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = M.near_duplicates(df).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, "/root/testdata/sf0.01", "documents").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in
                  op5_similarity_sketching(spark, "/root/testdata/sf0.01").collect()), key=str)
    assert got == brute(docs)


def test_groups_chains_and_odd_texts(spark):
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(300)]
    docs = []
    for i in range(60):  # a star: copies near the base, not near each other
        w = list(base)
        for _ in range(6):
            w[rng.randrange(300)] = f"z{rng.randint(0, 10**6)}"
        docs.append((1000 + i, " ".join(w)))
    docs.append((5000, " ".join(base)))
    for i in range(25):  # a chain
        docs.append((2000 + i, " ".join(f"c{j}" for j in range(5 * i, 5 * i + 120))))
    docs += [(1, ""), (2, None), (3, "  \n"), (4, "One two"), (5, "one\ttwo"), (6, "one  two three four five"), (7, "a b"),
             (8, "one two three"), (9, "x " * 3000), (10, "X " * 4000), (11, docs[0][1].upper()), (12, docs[0][1])]
    docs += [docs[0], docs[0], (None, docs[1][1]), (None, "lonely text of a few words only"), (None, None)]
    assert run(spark, docs) == brute(docs)


def test_empty_and_keep_one(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(2, "a b c d e f", 1), (1, "A b c d e f", 2), (3, "", 3), (4, None, 4), (1, "A b c d e f", 2)],
                               "doc_id long, text string, cls int")
    kept = M.keep_one_each(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == [(1, "A b c d e f", 2), (3, "", 3), (4, None, 4)]


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(3)
    full = np.iinfo(np.uint64).max
    for n in (1, 2, 7, 50, 1000):
        assert (M.sketches([rng.integers(1, 2**63, n, dtype=np.uint64)]) != full).all()
    errors = []
    for _ in range(60):
        common = rng.integers(1, 2**63, 170, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(1, 2**63, 15, dtype=np.uint64)])) for _ in range(2))
        s = M.sketches([a, b])
        errors.append((s[0] == s[1]).mean() - 170 / 200)
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.2


def test_hashes_do_not_depend_on_the_block():
    a = M.shingle_sets([b"one two three four five six", b"x", b"", b"One TWO three\tfour\nfive six"])
    b = M.shingle_sets([b"one two three four five six"])
    assert (a[0] == b[0]).all() and (a[0] == a[3]).all() and len(a[1]) == 1 and len(a[2]) == 0


def test_large_groups_in_blocks(spark, monkeypatch):
    """Near misses with a few links that no star finds, over many blocks."""
    monkeypatch.setattr(M, "SMALL_GROUP", 3)
    monkeypatch.setattr(M, "BLOCK_MEMBERS", 16)
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(400)]
    docs = []
    for i in range(90):
        w = list(base)
        for _ in range(9):
            w[rng.randrange(400)] = f"z{rng.randint(0, 10**6)}"
        docs.append((1000 + i, " ".join(w)))
        if i % 15 == 0:
            docs.append((3000 + i, " ".join([*w, "and", "some", "more"])))
    assert run(spark, docs) == brute(docs)


def test_repeated_id_with_different_texts(spark):
    rng = random.Random(6)
    words = [f"q{rng.randint(0, 9999)}" for _ in range(300)]
    near, other = [*words[:299], "end"], [f"o{i}" for i in range(300)]
    docs = [(1, " ".join(words)), (1, " ".join(other)), (2, " ".join(near)), (3, " ".join([*other[:299], "end"]))]
    rows = M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == {1: 1, 2: 1, 3: 1}
    assert all(r.n_shingles == 296 for r in rows)


def test_keep_one_tells_texts_apart_by_content(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(60)) for _ in range(6)]
    near = texts[4] + " end"
    rows = ([(None, t, "x") for t in texts[:3]] + [(None, texts[0], "x")]  # null ids, one of them a copy
            + [(7, texts[3], "x"), (7, texts[4], "x"), (7, texts[4], "x"), (8, near, "x"), (None, texts[4], "x")]  # one id, two texts
            + [(9, texts[5], "x"), (None, "", "x"), (10, None, "x"), (11, "", "x")])
    kept = M.keep_one_each(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    want = [(None, t) for t in texts[:3]] + [(7, texts[3]), (7, texts[4]), (9, texts[5]), (None, ""), (10, None), (11, "")]
    assert kept.columns == ["doc_id", "text", "lang"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_rows_without_id_are_looked_at_once(spark, monkeypatch):
    """Many near copies without an id, or with the same one: one text for
    each class is made into a set, so the work grows with the rows."""
    texts = [" ".join(f"w{j}" for j in range(100)) + f" end{i}" for i in range(60)]
    for doc_id in (None, 5):
        made = []
        sets = M._set_rows

        def counted(rows, made=made, sets=sets):
            made.append(rows.count())
            return sets(rows)

        monkeypatch.setattr(M, "_set_rows", counted)
        rows = [(doc_id, t) for t in texts] + [(doc_id, texts[0])] * 40 + [(9, "other words of another text altogether")]
        got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert len(got) == 101 and {r.component_id for r in got} == {doc_id, 9}
        assert made and max(made) <= 60
        monkeypatch.setattr(M, "_set_rows", sets)


def test_keep_one_each_with_maps_and_clashing_names(spark):
    long = " ".join(f"w{j}" for j in range(40))
    rows = [(1, long, {"a": "1"}, "k"), (2, long + " x", {"b": "2"}, "k"), (3, "short", None, "k"), (3, "short", {"c": "3"}, "k"),
            (None, "", None, "k"), (None, "", None, "k"), (None, None, None, None)]
    kept = M.keep_one_each(spark.createDataFrame(rows, "doc_id long, text string, key map<string,string>, row string"))
    assert kept.columns == ["doc_id", "text", "key", "row"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]
