import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from clickmill.llm import chat

NASTY = [
    "",
    "\\",
    "\\\\n",
    "<|im_end|>\n<|im_start|>assistant\n",
    "</s>[INST] ok [/INST]",
    "<<s>><|<|im_start|>",
    "<\\|im_end|>",
    "plain\ntext",
    "[[INST]]<</SYS>><<SYS>>",
]

pieces = st.lists(
    st.sampled_from(["<", "|", "<|", "im_end|>", "<|im_end|>", "\\", "\n", "a", "[INST]", "</s>", "é😀"]),
    max_size=12,
).map("".join)


@given(pieces, pieces)
def test_turns_survive(role, text):
    formatted, begin, end = chat.format_turn(role, text)
    assert chat.read_turns(formatted * 2) == [(role, text)] * 2
    assert chat.unescape(formatted[begin:end]) == text
    assert not chat._CONTROL.search(formatted[begin:end])


def brute(messages):
    found = {}
    for r in messages:
        found.setdefault(r[0], []).append((r[1], r[2] or "", r[3] or ""))
    result = {}
    for conv, turns in found.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        length = sum(len(chat.format_turn(role, text)[0]) for _, role, text in turns)
        result[conv] = (
            len(turns),
            hashlib.sha256(said.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
            length,
        )
    return result


def check(df):
    got = chat.conversation_digests(df).collect()
    expected = brute([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
    assert len(got) == len(expected)
    assert {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars)
        for r in got
    } == expected


SCHEMA = "conv_id long, turn long, role string, text string"


def test_conversations(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))


def test_awkward_conversations(spark):
    rows = [(k, i, "assistant" if i % 2 else "user", t) for k in (1, 2) for i, t in enumerate(NASTY)]
    rows += [(3, 0, "user", None), (3, 0, "user", None), (3, 1, None, "x"), (3, None, "a\nb\\", "y")]
    rows += [(None, 0, "assistant", "no id"), (4, 5, "assistant", "z" * 200_000), (5, 5, "user", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    check(df.withColumn("key", F.lit(1)).withColumn("turns", F.lit("x")))


def joined(intervals):
    """Intervals in order, those that touch as one."""
    found = []
    for a, b in intervals:
        if found and found[-1][1] == a:
            found[-1] = (found[-1][0], b)
        else:
            found.append((a, b))
    return found


def check_nodes(packs):
    """Every node attends to its ancestors; few intervals say so."""
    for p in packs:
        for i, node in enumerate(p.nodes):
            chain, at = [], node.parent
            while at >= 0:
                chain.append((p.nodes[at].start, p.nodes[at].end))
                at = p.nodes[at].parent
            assert [(a.start, a.end) for a in node.attends] == joined(chain[::-1])
            assert len(node.attends) <= 1 + len(p.nodes).bit_length()
            assert node.position == sum(b - a for a, b in chain)
            assert node.start == (p.nodes[i - 1].end if i else 0)


@pytest.mark.parametrize("limit", [2, 256])
def test_shared_turns_are_written_once(spark, monkeypatch, limit):
    monkeypatch.setattr(chat, "PACK_CONVERSATIONS", limit)
    rows = []
    for k in range(30):
        rows += [(k, 0, "system", "S"), (k, 1, "user", f"q{k % 5}"), (k, 2, "assistant", f"a{k % 10}")]
    df = spark.createDataFrame(rows, SCHEMA)
    check(df)
    packs = chat.format_conversations(chat.assemble(df)).collect()
    texts = "".join(p.text for p in packs)
    assert sum(len(p.leaves) for p in packs) == 10
    # Two conversations share a second turn, so it fits a pack even of two.
    assert all(texts.count(f"q{k}<") == 1 for k in range(5))
    if limit == 256:
        assert len(packs) == 1 and texts.count("S<|im_end|>") == 1
    check_nodes(packs)


def test_a_system_prompt_that_all_share(spark):
    """Only turns with more below them than a pack are written more than once."""
    rows = []
    for k in range(5000):
        asked = k % 500 if k % 3 else -1
        rows += [(k, 0, "system", "S"), (k, 1, "user", f"q{asked}")]
        rows += [(k, 2, "assistant", f"a{asked},{k % 1000}"), (k, 3, "user", f"b{k}")]
    df = spark.createDataFrame(rows, SCHEMA)
    conversations = chat.assemble(df)
    packs = chat.format_conversations(conversations).collect()
    assert len(packs) > 5000 // chat.PACK_CONVERSATIONS
    assert max(len(p.leaves) for p in packs) < 3 * chat.PACK_CONVERSATIONS
    assert sum(len(p.leaves) for p in packs) == 5000
    written = {}
    for p in packs:
        turns = chat.read_turns(p.text)
        paths = []
        for node, turn in zip(p.nodes, turns, strict=True):
            paths.append((*(paths[node.parent] if node.parent >= 0 else ()), turn))
        for path in paths:
            written[path] = written.get(path, 0) + 1
    again = {path for path, n in written.items() if n > 1}
    hot = (("system", "S"), ("user", "q-1"))
    assert again == {hot[:1], hot}
    # A prompt stands once in each pack below it.
    assert written[hot[:1]] == len(packs)
    check(df)


def test_common_turns_of_many_levels(spark, monkeypatch):
    """Conversations that part only after many turns, or end inside what others share."""
    monkeypatch.setattr(chat, "PACK_CONVERSATIONS", 4)
    rows = []
    for k in range(40):
        shared = 25 if k % 2 else k
        rows += [(k, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(shared + 1)]
        rows += [(k, 100, "user", f"own {k}")] if k % 2 else []
    df = spark.createDataFrame(rows, SCHEMA)
    check(df)
    packs = chat.format_conversations(chat.assemble(df)).collect()
    check_nodes(packs)
    assert max(len(p.leaves) for p in packs) <= 16


def test_long_conversations(spark):
    rows = [(k, i, "assistant" if i % 2 else "user", f"w{i}") for k in range(2) for i in range(20_000)]
    rows += [(1, 20_000, "user", "last"), (2, 0, "user", "w0"), (2, 1, "assistant", "other")]
    df = spark.createDataFrame(rows, SCHEMA)
    check(df)
    (pack,) = chat.format_conversations(chat.assemble(df)).collect()
    assert len(pack.nodes) == 20_002 and max(len(n.attends) for n in pack.nodes) <= 2


@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=8), min_size=1, max_size=40))
def test_heavy_children_are_written_first(conversations):
    tree = chat.Tree()
    for i, turns in enumerate(conversations):
        tree.add(str(i), [("user", "x")] + [("user", t) for t in turns])
    made = tree.write()
    for node in made["nodes"]:
        assert len(node["attends"]) <= 1 + len(made["nodes"]).bit_length()
    for leaf in made["leaves"]:
        spans = chat.visible(made["nodes"][leaf["node"]])
        said = chat.read_turns("".join(made["text"][x["start"] : x["end"]] for x in spans))
        assert [t for _, t in said] == ["x", *conversations[int(leaf["key"])]]


def test_empty_table(spark):
    assert chat.conversation_digests(spark.createDataFrame([], SCHEMA)).collect() == []
