import hashlib
import random

from pyspark.sql import functions as F

from sigloom.llm import chat, layout_queries

ODD = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>x<|im_sep|>", "\\", "\\\\<|", "a\\<|b", "<<SYS>> <</sys>> <S> <unk>", "", " é🙂\n", "<|<|", "[[INST]", "y" * 50_000]


def back(df):
    rows = df.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("told"))
    return rows.collect()


def test_best_path_of_random_trees(spark):
    draw, rows, want = random.Random(4), [], {}
    for tree in range(12):
        parent = {0: None}
        for node in range(1, draw.randint(2, 40)):
            parent[node] = draw.randrange(max(0, node - 3), node)
        score = {n: draw.choice([None, 0.5, 1.0, -1.0, 2.0]) for n in parent}
        rows += [(tree, n, p, "user" if n % 2 else "assistant", f"{tree}.{n}", score[n]) for n, p in parent.items()]
        leaves = [n for n in parent if n not in parent.values()]

        def path(n, parent=parent):
            return [] if n is None else [*path(parent[n]), n]

        ranked = sorted(leaves, key=lambda n: (-sum(score[x] or 0 for x in path(n)), -len(path(n)), n))
        want[tree] = [[f"{tree}.{x}" for x in path(n)] for n in ranked[:2]]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    got = {}
    for r in back(chat.format_chat(nodes, "tree", "node", "parent", "role", "text", "score", keep=2)):
        got.setdefault(r.tree, []).append([t.text for t in r.turns])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_texts_read_back_and_edges(spark):
    rows = [(1, i, ("assistant", "user", None, "a\\<|b\n")[i % 4], t, 3) for i, t in enumerate(ODD)]
    rows += [(None, 0, "assistant", None, 1), (None, None, "user", "q", 1), (2, 5, "user", "same", 1), (2, 5, "user", "same", 1)]
    conv = spark.createDataFrame([(r[0], r[1], r[2], r[3], "x") for r in rows], "conv_id long, turn long, role string, text string, node string")
    got = {r.conv_id: r for r in back(chat.format_chat(chat.chains(conv), "conv_id", "node", "parent", "role", "text", "score"))}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2] or "", r[3] or "") for r in rows if r[0] == 1]
    assert got[1].told == "".join(r[3] for r in rows if r[0] == 1 and r[2] == "assistant")
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "q"), ("assistant", "")] and got[None].told == ""
    assert [t.text for t in got[2].turns] == ["same", "same"]
    assert back(chat.format_chat(chat.chains(conv.limit(0)), "conv_id", "node", "parent", "role", "text", "score")) == []


def test_long_chain_and_missing_parents(spark):
    rows = [(1, i, i - 1, "user", str(i), 0.0) for i in range(200)] + [(2, 5, 4, "user", "root", 0.0)]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    got = {r.tree: [t.text for t in r.turns] for r in back(chat.format_chat(nodes, "tree", "node", "parent", "role", "text", "score"))}
    assert got == {1: [str(i) for i in range(200)], 2: ["root"]}


def test_query(spark, sf):
    talk = {-1: [("user", ODD[0]), ("assistant", ODD[0])]}
    for r in sorted(spark.read.parquet(f"{sf}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        talk.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    got = layout_queries.op9_chat_format(spark, sf).collect()
    assert len(got) == len(talk)
    for r in got:
        turns = talk[r.conv_id]
        told = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(told))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(told.encode()).hexdigest()


def test_rows_without_a_node_id(spark):
    """They are paths of their own; the tree that they stand in keeps its best path."""
    rows = [(1, 0, None, "user", "a", 1.0), (1, 1, 0, "assistant", "b", 1.0), (1, None, 0, "user", "lost", 0.5), (1, None, None, "user", "lost", 0.5)]
    rows += [(2, None, None, "user", "only", None)]
    nodes = spark.createDataFrame([(*r, 1) for r in rows], "tree long, node long, parent long, role string, text string, score double, leaf int")
    best = back(chat.format_chat(nodes, "tree", "node", "parent", "role", "text", "score"))
    assert sorted((r.tree, [t.text for t in r.turns], r.leaf) for r in best) == [(1, ["a", "b"], 1), (2, ["only"], None)]
    every = back(chat.format_chat(nodes, "tree", "node", "parent", "role", "text", "score", keep=9))
    assert sorted((r.tree, [t.text for t in r.turns]) for r in every) == [(1, ["a", "b"]), (1, ["lost"]), (1, ["lost"]), (2, ["only"])]
