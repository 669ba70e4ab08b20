"""Chat formatting as prefix trees.

Conversations that begin with the same turns share them. A tree is written once, depth first,
into one formatted text; every turn is a node with its interval in that text, its first
position id (the characters before it in its conversation; tokens are characters here), its
parent, and the intervals of its ancestors, which are what it may attend to. Intervals that
touch are one. The child with the most turns below it is written first, right behind its
parent, so a path leaves its interval at most log2(turns of the tree) times, however long it
is. A conversation is a leaf: the intervals of its ancestors and its own last turn, one after
another, are its formatted text.

Template: ``<|im_start|>role``, newline, text, ``<|im_end|>``, newline. Inside roles and texts
every backslash is doubled, and one is put after the first character of every control string
(also those of other templates), so no control string can come from a text. Dropping the
backslashes gives the text back exactly. The loss covers assistant texts, without marks.

Equal conversations are one leaf. A tree never meets in one task whole: conversations are
dealt into packs by their first turn. Where more conversations share it than a pack holds, they
are dealt by their next turn, and so on down the tree, so only turns with more below them than
a pack are written again, once in each pack below; a turn with less below it is written once.
Levels are looked at in windows that double, so the rounds grow with the logarithm of the turns
that too many conversations share. One conversation is the unit of work, whatever its length.

Defined results: null texts and roles are empty; turns are ordered by turn (null first), then
role, then text, and repeated rows are turns of their own; rows with a null conv_id are one
conversation; extra columns are passed over; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import bounded_broadcast, store

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
# Conversations of a pack, about, and characters of a pack, about.
PACK_CONVERSATIONS = 256
PACK_CHARS = 1 << 20

# An odd factor and a mask of 64 bits, for the numbers that name paths.
_MIX, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1

_CONTROL = re.compile(
    r"(?=<\||</?s>|\[/?INST\]|<</?SYS>>|<unk>|<pad>|<bos>|<eos>|</?start_of_turn>|</?end_of_turn>)(.)",
    re.DOTALL,
)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(
    re.escape(START) + r"((?:\\.|[^\\\n])*)\n((?:\\.|[^\\<]|<(?!\|))*)" + re.escape(END) + r"\n",
    re.DOTALL,
)


def escape(text: str) -> str:
    """``text`` without control strings, reversibly."""
    return _CONTROL.sub(r"\1" + "\\\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text begins and ends in it."""
    head = f"{START}{escape(role)}\n".replace("\n", "\\\n", role.count("\n"))
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


class Tree:
    """Prefix tree of conversations, written depth first."""

    def __init__(self):
        self.children: list[dict[tuple[str, str], int]] = [{}]
        self.parents: list[int] = [-1]
        self.leaves: list[list[str]] = [[]]

    def add(self, key: str, turns: list[tuple[str, str]]) -> None:
        node = 0
        for turn in turns:
            own = self.children[node]
            if turn not in own:
                own[turn] = len(self.children)
                self.children.append({})
                self.parents.append(node)
                self.leaves.append([])
            node = own[turn]
        self.leaves[node].append(key)

    def _heavy_last(self) -> list[list[tuple[tuple[str, str], int]]]:
        """Children of every node, the one with the most turns below it last, ties by turn."""
        below = [1] * len(self.parents)
        for node in range(len(below) - 1, 0, -1):
            below[self.parents[node]] += below[node]
        return [
            sorted(own.items(), key=lambda c: (-below[c[1]], c[0]), reverse=True)
            for own in self.children
        ]

    def write(self) -> dict:
        """Text, nodes in depth-first order, and leaves by node."""
        children = self._heavy_last()
        parts: list[str] = []
        nodes: list[dict] = []
        leaves = []
        at = 0
        # (turn, node in the tree, parent among the written nodes, characters before it)
        todo = [(t, n, -1, 0) for t, n in children[0]]
        while todo:
            (role, text), node, parent, position = todo.pop()
            formatted, begin, end = format_turn(role, text)
            loss = role == LOSS_ROLE
            number = len(nodes)
            nodes.append(
                {
                    "parent": parent,
                    "start": at,
                    "end": at + len(formatted),
                    "position": position,
                    "loss_start": at + begin if loss else at,
                    "loss_end": at + end if loss else at,
                    "attends": visible(nodes[parent]) if parent >= 0 else [],
                }
            )
            parts.append(formatted)
            at += len(formatted)
            leaves += [{"key": k, "node": number} for k in self.leaves[node]]
            following = position + len(formatted)
            todo += [(t, n, number, following) for t, n in children[node]]
        return {"text": "".join(parts), "nodes": nodes, "leaves": leaves}


def visible(node: dict) -> list[dict]:
    """Intervals of a node's ancestors and its own; those that touch are one."""
    above = list(node["attends"])
    if above and above[-1]["end"] == node["start"]:
        return [*above[:-1], {"start": above[-1]["start"], "end": node["end"]}]
    return [*above, {"start": node["start"], "end": node["end"]}]


PACK_SCHEMA = (
    "pack long, text string, nodes array<struct<parent: int, start: long, end: long, "
    "position: long, loss_start: long, loss_end: long, "
    "attends: array<struct<start: long, end: long>>>>, "
    "leaves array<struct<key: string, node: int>>"
)


def _write_pack(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per first turn of a pack."""
    trees: dict[tuple[str, str], Tree] = {}
    for key, turns in zip(rows["key"], rows["turns"], strict=True):
        turns = [(t["role"], t["text"]) for t in turns]
        trees.setdefault(turns[0], Tree()).add(key, turns)
    written = [trees[k].write() for k in sorted(trees)]
    return pd.DataFrame({"pack": int(rows["pack"].iloc[0]), **pd.DataFrame(written)})


def assemble(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``key`` (hash of all turns) and ``turns`` of every conversation."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = F.sort_array(F.collect_list(turn))
    said = F.transform(
        "turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    )
    found = messages.groupBy("conv_id").agg(turns.alias("turns")).withColumn("turns", said)
    return found.withColumn("key", F.sha2(F.to_json("turns"), 256))


def _with_paths(distinct: DataFrame) -> DataFrame:
    """``key``, ``chars`` and ``path``: one number per turn that names it with all before it."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            paths = []
            for hashes in batch.pop("hashes"):
                path, at = [], 0
                for h in hashes.tolist():
                    at = ((at ^ h) * _MIX + 1) & _MASK
                    at ^= at >> 29
                    path.append(at)
                paths.append(np.array(path, dtype=np.uint64).view(np.int64))
            yield batch.assign(path=paths)

    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.length(t["text"]))
    hashes = F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"]))
    return distinct.select("key", chars.alias("chars"), hashes.alias("hashes")).mapInPandas(
        compute, "key string, chars long, path array<long>"
    )


def _load(rows: DataFrame, node: str) -> DataFrame:
    """``parts``: packs that the conversations below a node fill, by conversations and characters."""
    n, chars = F.count(F.lit(1)), F.sum("chars")
    parts = F.greatest(F.ceil(n / PACK_CONVERSATIONS), F.ceil(chars / PACK_CHARS), F.lit(1))
    # One conversation cannot be dealt, whatever its length.
    return rows.groupBy(node).agg(F.when(n > 1, parts).otherwise(1).alias("parts"))


def _depths(paths: DataFrame) -> DataFrame | None:
    """``key`` and the number of turns, from the first, below which a pack is not enough.

    Only conversations whose first turn has too much below it; ``None`` if there are none.
    """
    found, active, start, n = None, paths, 1, 1
    while True:
        levels = active.select(
            "key", "chars", F.posexplode(F.slice("path", start, n)).alias("at", "node")
        )
        full = store(_load(levels, "node").filter(F.col("parts") > 1).select("node"), "chat-full")
        if full.isEmpty():
            return found
        deep = levels.join(bounded_broadcast(full, 8), "node").groupBy("key")
        deep = store(deep.agg((F.max("at") + start).alias("depth")), "chat-depths")
        found = deep if found is None else found.union(deep)
        on = deep.filter(F.col("depth") == start + n - 1).select("key")
        active = store(active.join(on, "key", "left_semi"), "chat-active")
        start, n = start + n, 2 * n


def deal(distinct: DataFrame) -> DataFrame:
    """``key``, ``turns`` and ``pack`` of distinct conversations (``key``, ``turns``)."""
    paths = store(_with_paths(distinct), "chat-paths")
    total = max(1, -(-paths.count() // PACK_CONVERSATIONS))
    # Trees that fit share packs.
    root = F.pmod(F.xxhash64(F.col("turns")[0]["role"], F.col("turns")[0]["text"]), F.lit(total))
    found = _depths(paths)
    if found is None:
        return distinct.select("key", "turns", root.alias("pack"))
    depth = found.groupBy("key").agg(F.max("depth").alias("depth"))
    # The turn that is dealt, and the one below it, which is not cut again.
    node, child = F.get("path", F.col("depth") - 1), F.get("path", "depth")
    below = paths.join(depth, "key").select(
        "key", "chars", node.alias("node"), F.coalesce(child, node).alias("child")
    )
    below = store(below, "chat-below")
    parts = store(_load(below, "node"), "chat-parts")
    own = below.join(bounded_broadcast(parts, 16), "node").select(
        "key", F.xxhash64("node", F.pmod(F.xxhash64("child"), F.col("parts"))).alias("own")
    )
    own = bounded_broadcast(store(own, "chat-own"), 96)
    return distinct.join(own, "key", "left").select(
        "key", "turns", F.coalesce("own", root).alias("pack")
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Packs of prefix trees of assembled conversations, one row per tree."""
    distinct = conversations.groupBy("key").agg(F.any_value("turns").alias("turns"))
    dealt = deal(store(distinct, "chat-distinct"))
    return dealt.groupBy("pack").applyInPandas(_write_pack, PACK_SCHEMA)


def read_back(packs: DataFrame) -> DataFrame:
    """Digests of every conversation, from the formatted packs alone.

    One row per distinct conversation: ``key``, number of turns, digests of the turns and of
    the text under the loss, and its length as formatted.
    """

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, nodes, leaves in zip(batch["text"], batch["nodes"], batch["leaves"], strict=True):
                for leaf in leaves:
                    at = leaf["node"]
                    parts = [text[x["start"] : x["end"]] for x in visible(nodes[at])]
                    loss = []
                    while at >= 0:
                        node = nodes[at]
                        loss.append(unescape(text[node["loss_start"] : node["loss_end"]]))
                        at = node["parent"]
                    loss.reverse()
                    turns = read_turns("".join(parts))
                    said = "".join(f"{role}\n{body}\n" for role, body in turns)
                    learned = "".join(loss)
                    rows.append(
                        {
                            "key": leaf["key"],
                            "n_turns": len(turns),
                            "turns_sha256": hashlib.sha256(said.encode()).hexdigest(),
                            "loss_chars": len(learned),
                            "loss_sha256": hashlib.sha256(learned.encode()).hexdigest(),
                            "formatted_chars": sum(map(len, parts)),
                        }
                    )
            yield pd.DataFrame(rows, columns=DIGESTS)

    return packs.select("text", "nodes", "leaves").mapInPandas(
        compute,
        "key string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )


DIGESTS = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def conversation_digests(messages: DataFrame) -> DataFrame:
    """``conv_id`` and the digests of its turns as read back from the formatted packs."""
    conversations = store(assemble(messages), "chat-conversations")
    digests = store(read_back(format_conversations(conversations)), "chat-digests")
    return conversations.select("conv_id", "key").join(digests, "key").drop("key")
