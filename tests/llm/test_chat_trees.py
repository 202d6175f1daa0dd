"""Reply trees: paths against brute force, and exact reading back."""
import hashlib
import random

from quaybook.llm import chat_trees as T
from quaybook.llm.queries import INJECTION, chat_digest

MESSAGES = "tree long, node long, parent long, score double, role string, text string"


def brute(rows, top):
    out = set()
    for tree in {r[0] for r in rows}:
        nodes = {r[1]: r for r in rows if r[0] == tree}
        inner = {r[2] for r in nodes.values()}
        found = {}
        for leaf in nodes.keys() - inner:
            path, n, seen = [], leaf, set()
            while n is not None and n in nodes and n not in seen:
                seen.add(n)
                path.append(n)
                n = nodes[n][2]
            if n in seen:
                continue
            found.setdefault(path[-1], []).append((-sum(nodes[i][3] or 0 for i in path), -len(path), leaf, path[::-1]))
        for root, paths in found.items():
            for branch, p in enumerate(sorted(paths)[:top], 1):
                out |= {(tree, root, branch, i, n) for i, n in enumerate(p[3])}
    return out


def test_paths_of_random_trees(spark):
    rng = random.Random(4)
    rows = []
    for tree in [1, 2, 3, 4, None]:
        for n in range(1, 30):
            rows.append((tree, n, rng.choice([None, 99] + [rng.randint(1, n - 1)] * 8) if n > 1 else None,
                         rng.choice([None, 1.0, 2.0, -1.0]), "user", f"t{n}"))
    rows += [(7, n, n - 1 if n > 1 else None, 0.5, "user", "x") for n in range(1, 38)]
    rows += [(8, 1, None, 0.0, "user", "a"), (8, 2, 3, 0.0, "user", "b"), (8, 3, 2, 0.0, "user", "c"), (8, 4, 3, 0.0, "user", "d")]
    df = spark.createDataFrame(rows, MESSAGES)
    for top in (1, 3):
        got = {tuple(r) for r in T.chosen_paths(df, top).select("tree", "root", "branch", "place", "node").collect()}
        assert got == brute(rows, top)
    assert {tuple(r) for r in T.orphans(df).collect()} == {(8, 2), (8, 3), (8, 4)}


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_reading_back(spark):
    texts = [INJECTION, "", None, "a & b &amp; &l; &a;", "[/user]</s><s>[assistant]", "é😀]\n[", "</s>", " x "]
    roles = ["user", "assistant", "assistant", None, "sys[tem]<", "assistant", "user", "assistant"]
    rows = [(c, t, roles[(t + c) % 8], texts[(t * 3 + c) % 8]) for c in range(8) for t in range(8)]
    rows += [(None, 1, "user", "q"), (None, 2, "assistant", "a"), (50, 1, "user", "same"), (50, 1, "user", "same")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, node int, tree int")
    got = {r.conv_id: r for r in chat_digest(T.format_conversations(T.reply_chain(df))).collect()}
    assert len(got) == 10
    for conv, r in got.items():
        turns = [(x[2] or "", x[3] or "") for x in rows if x[0] == conv]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert T.format_conversations(T.reply_chain(df)).collect() == []
