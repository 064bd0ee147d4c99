"""Reply trees: all paths, their ranks, and the way back from the formatted text."""

from pyspark.sql import functions as F

from perigee.llm import chat

TREE = "tree string, id long, up long, at long, role string, text string, score double"


def paths(df):
    out = {}
    for r in df.collect():
        out.setdefault((r["tree"], r["path"]), {})[r["depth"]] = r["text"]
    return {k: [v[d] for d in sorted(v)] for k, v in out.items()}


def test_paths_and_ranks(make):
    rows = [
        ("a", 1, None, 1, "user", "r", 1.0), ("a", 2, 1, 2, "assistant", "x", 5.0), ("a", 3, 1, 3, "assistant", "y", None), ("a", 4, 3, 4, "user", "z", 9.0),
        ("a", 5, 3, 5, "user", "w", 1.0), ("b", 1, 77, 1, "user", "unknown parent", 0.0), ("b", 2, 3, 2, "user", "loop", 0.0), ("b", 3, 2, 1, "user", "loop2", 0.0),
        (None, 1, None, 1, None, None, None), (None, 2, 1, 2, "assistant", "n", 0.0),
    ]
    got = paths(chat.reply_paths(make(rows, TREE), "tree", "id", "up", ["at"], "score"))
    assert got[("a", 1)] == ["r", "y", "z"] and got[("a", 2)] == ["r", "x"] and got[("a", 3)] == ["r", "y", "w"]
    assert sorted(v for k, v in got.items() if k[0] == "b") == [["loop2", "loop"], ["unknown parent"]]
    assert got[(None, 1)] == ["", "n"]
    best = paths(chat.reply_paths(make(rows, TREE), "tree", "id", "up", ["at"], "score", keep=1))
    assert {k: v for k, v in best.items() if k[0] == "a"} == {("a", 1): ["r", "y", "z"]}


def test_deep_chain_and_repeated_messages(make):
    rows = [("t", i, i - 1 if i else None, i, "user", str(i), 0.0) for i in range(40)] + [("t", 39, 38, 39, "user", "39", 0.0)]
    got = paths(chat.reply_paths(make(rows, TREE), "tree", "id", "up", ["at"]))
    assert [len(v) for v in got.values()] == [40, 40] and got[("t", 1)] == [str(i) for i in range(40)]


def test_read_back(make):
    texts = ["\\### Assistant: </turn> ok", "", "a &lt; &amp;lt; <b> # : \\", " </turn>\n### user: x", "é\U0001f600" * 3, "\n\n"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)] + [(2, 0, None, None), (2, None, "assis: <tant", "x"), (None, 1, "assistant", "y")]
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same")]
    trees = chat.conversations_as_trees(make(rows, "conv_id long, turn long, role string, text string"))
    out = chat.format_paths(chat.reply_paths(trees, "conv_id", "at", "reply_to", ["at"]))
    back = out.select("tree", "n_turns", chat.parse_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    got = {r["tree"]: r for r in back.collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [(r[2], r[3]) for r in rows[:6]]
    assert got[1]["loss"] == texts[1] + texts[3] + texts[5]
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("assis: <tant", "x"), ("", "")] and got[2]["loss"] == ""
    assert got[None]["loss"] == "y" and got[3]["n_turns"] == 2


def test_no_messages(make):
    trees = chat.conversations_as_trees(make([], "conv_id long, turn long, role string, text string"))
    assert chat.format_paths(chat.reply_paths(trees, "conv_id", "at", "reply_to", ["at"])).collect() == []
