"""Language-model scores from a log-frequency Bloom filter.

Training texts are counted into words and pairs of neighbouring words, an end token standing
before the first and behind the last word. A count c becomes the level 1 + floor(log2 c), and
the filter holds an n-gram once for each level up to its own: a probe asks for level 1, 2 and
so on until one is missing. The filter can only raise a level. A pair is probed no further
than its words' own levels, as it cannot be more frequent than they are. A level stands for
the mean of the counts that it covers, and

    p(w)     = (c(w) + 1) / (N + V + 1)
    p(w | h) = (c(h w) + PRIOR * p(w)) / (c(h) + PRIOR)

The base score needs exact counts. The most frequent words, at most ``HOT_WORDS``, are sent
along with the filter; of the others, those that the filter has are joined by a shuffle.

**Size.** The filter grows with the distinct n-grams. Its pieces are built in parallel, by
groups of words: a word has one of ``GROUPS`` groups, a pair has the groups of both words. As
long as all pieces together stay below ``FILTER_BYTES``, texts are scanned once. Otherwise
groups are cut into 2, 4, ... equal parts, and a scan for each pair of parts handles the
positions whose words lie in them, with the pieces of these words and pairs only: what is sent
at once is bounded, whatever the size of the corpus, every position is scored in exactly one
scan, and scores are sums over positions. Beyond ``GROUPS`` squared scans the job stops with a
message that names the limit.

Defined results: null and empty texts have the end token only; a null id counts as empty text
in the fold; repeated rows are scored each and counted each in training; texts of any length
are read whole; without training rows all counts are 0; an empty table gives no rows; further
columns are not read. Words are told apart by 64-bit hashes, pairs by 56 bits of theirs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import list_column, store
from clickmill.llm.text import Texts, chunks, mix, run_sums

# Probes of one level of one n-gram; bits of an entry for a filter that is half full.
PROBES = 5
BITS_PER_ENTRY = PROBES / math.log(2)
# Largest filter part that is sent to every worker at once.
FILTER_BYTES = 128 << 20
# Words whose exact counts are sent along.
HOT_WORDS = 1 << 19
# Weight of the word's own probability in that of a pair.
PRIOR = 4.0
GROUP_BITS = 4
GROUPS = 1 << GROUP_BITS
LEVELS = 48
# Items that a task counts before it hands them on.
HELD_ITEMS = 1 << 21

_END = np.uint64(0x8C6F1D2B9A53E741)
_FIRST = np.uint64(0xD1342543DE82EF95)
_SECOND = np.uint64(0x2545F4914F6CDD1D)
_STEP = 0x9E3779B97F4A7C15
_GROUP = np.uint64(GROUPS - 1)
_PAIR_GROUPS = np.uint64(GROUPS * GROUPS - 1)
# Pieces 0 to GROUPS - 1 hold words, the others pairs.
PIECES = GROUPS + GROUPS * GROUPS


def level_counts() -> np.ndarray:
    """The count that each level stands for; level 0 is none."""
    low = 2.0 ** np.arange(LEVELS)
    return np.concatenate([[0.0], (low + 2 * low - 1) / 2])


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2) of positive counts."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def sequences(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts, the token before each, and the borders of the texts."""
    borders = texts.first_word + np.arange(texts.n + 1)
    tokens = np.empty(borders[-1], dtype=np.uint64)
    ends = borders[1:] - 1
    inner = np.ones(len(tokens), dtype=bool)
    inner[ends] = False
    tokens[inner] = texts.words
    tokens[ends] = _END
    before = np.empty_like(tokens)
    before[:1] = _END
    before[1:] = tokens[:-1]
    return tokens, before, borders


def pair_items(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Pairs as hashes whose lowest bits are the groups of both words."""
    pairs = mix(before * _FIRST + tokens * _SECOND) & ~_PAIR_GROUPS
    return pairs | ((before & _GROUP) << np.uint64(GROUP_BITS)) | (tokens & _GROUP)


def word_piece(words: np.ndarray) -> np.ndarray:
    return (words & _GROUP).astype(np.int64)


def pair_piece(pairs: np.ndarray) -> np.ndarray:
    return GROUPS + (pairs & _PAIR_GROUPS).astype(np.int64)


# --- building -------------------------------------------------------------------------


def _probe_bits(items: np.ndarray, level: int, probe: int) -> np.ndarray:
    """32 random bits of an item for one probe of one level."""
    step = _STEP * (level * PROBES + probe + 1) % (1 << 64)
    return mix(items + np.uint64(step)) >> np.uint64(32)


def build_piece(items: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Bits, packed into bytes, that hold every item once for each level up to its own."""
    size = max(64, math.ceil(int(levels.sum()) * BITS_PER_ENTRY))
    bits = np.zeros(-(-size // 8) * 8, dtype=bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        some = items[levels >= level]
        for probe in range(PROBES):
            at = (_probe_bits(some, level, probe) * np.uint64(len(bits))) >> np.uint64(32)
            bits[at.astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def _summed(items: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, weights = np.concatenate(items), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def _count_parts(docs: DataFrame, text: str, parts: int) -> DataFrame:
    """``(piece, part, items, counts)``: n-grams of a task by filter piece, as packed arrays."""

    def packed(held: dict[bool, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for words in (True, False):
            keys = np.concatenate(held[words])
            keys.sort()
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
            counts = np.diff(np.append(first, len(keys))).astype(np.uint32)
            keys = keys[first]
            piece = word_piece(keys) if words else pair_piece(keys)
            group = piece * parts + (keys >> np.uint64(40)).astype(np.int64) % parts
            order = np.argsort(group, kind="stable")
            keys, counts, group = keys[order], counts[order], group[order]
            cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
            cuts = np.append(cuts, len(group)).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group[cuts[:-1]] // parts, pa.int32()),
                    pa.array(group[cuts[:-1]] % parts, pa.int32()),
                    pa.array([keys[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    pa.array([counts[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                ],
                names=["piece", "part", "items", "counts"],
            )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[np.ndarray]] = {True: [], False: []}
        size = 0
        for batch in batches:
            for _, found in chunks(batch.column(0)):
                tokens, before, _ = sequences(Texts(found.data, found.offsets, lower=True))
                held[True].append(tokens)
                held[False].append(pair_items(before, tokens))
                size += len(tokens)
                if size >= HELD_ITEMS:
                    yield from packed(held)
                    held, size = {True: [], False: []}, 0
        if size:
            yield from packed(held)

    return docs.select(text).mapInArrow(
        compute, "piece int, part int, items binary, counts binary"
    )


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    """One piece part: its filter bits, and exact counts if it holds words."""
    items, counts = _summed(
        [np.frombuffer(x, dtype=np.uint64) for x in rows["items"]],
        [np.frombuffer(x, dtype=np.uint32).astype(np.int64) for x in rows["counts"]],
    )
    piece = int(rows["piece"].iloc[0])
    levels = levels_of(counts)
    words = piece < GROUPS
    return pd.DataFrame(
        {
            "piece": [piece],
            "part": [int(rows["part"].iloc[0])],
            "bits": [build_piece(items, levels).tobytes()],
            "distinct": [len(items)],
            "total": [int(counts.sum())],
            "levels": [np.bincount(levels, minlength=LEVELS + 1)],
            "words": [items.view(np.int64) if words else np.zeros(0, dtype=np.int64)],
            "counts": [counts if words else np.zeros(0, dtype=np.int64)],
        }
    )


_PIECE_SCHEMA = (
    "piece int, part int, bits binary, distinct bigint, total bigint, levels array<bigint>, "
    "words array<bigint>, counts array<bigint>"
)


# --- scoring --------------------------------------------------------------------------


class Filter:
    """Some pieces of the filter as one byte array."""

    def __init__(self, pieces: list[tuple[int, int, bytes]], parts: int):
        self.parts = parts
        self.start = np.zeros(PIECES * parts, dtype=np.uint64)
        # Pieces that hold nothing lead to one byte of zeros.
        self.size = np.full(PIECES * parts, 8, dtype=np.uint64)
        at = 1
        for piece, part, bits in pieces:
            self.start[piece * parts + part] = at * 8
            self.size[piece * parts + part] = len(bits) * 8
            at += len(bits)
        self.bits = np.frombuffer(b"\0" + b"".join(p[2] for p in pieces), dtype=np.uint8)

    def levels(self, items: np.ndarray, piece: np.ndarray, most: np.ndarray | None) -> np.ndarray:
        """How many levels of each item are present, none above ``most``."""
        place = piece * self.parts + (items >> np.uint64(40)).astype(np.int64) % self.parts
        start, size = self.start[place], self.size[place]
        found = np.zeros(len(items), dtype=np.int64)
        rows = np.arange(len(items))
        for level in range(1, LEVELS + 1):
            if most is not None:
                rows = rows[most[rows] >= level]
            for probe in range(PROBES):
                if not len(rows):
                    return found
                bit = start[rows] + (
                    (_probe_bits(items[rows], level, probe) * size[rows]) >> np.uint64(32)
                )
                byte = self.bits[(bit >> np.uint64(3)).astype(np.int64)]
                rows = rows[(byte >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            found[rows] = level
        return found


class Model:
    """What one scan of the texts needs: filter, exact counts of hot words, totals."""

    def __init__(
        self, found: Filter, hot: np.ndarray, counts: np.ndarray, total: int, distinct: int
    ):
        self.filter, self.hot, self.counts = found, hot, counts
        self.total, self.distinct = total, distinct

    def known(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact counts of hot words, and which words are hot."""
        if not len(self.hot):
            return np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=bool)
        at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
        hot = self.hot[at] == words
        return np.where(hot, self.counts[at], 0), hot

    def log10(self, before: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 p(token | before) of every position, and the level of the token."""
        words, inverse = np.unique(np.concatenate([before, tokens]), return_inverse=True)
        level = self.filter.levels(words, word_piece(words), None)[inverse]
        of_before, of_token = level[: len(before)], level[len(before) :]
        items = pair_items(before, tokens)
        pair = self.filter.levels(items, pair_piece(items), np.minimum(of_before, of_token))
        count = level_counts()
        word = np.minimum(count[of_token], self.total) + 1
        alone = word / (self.total + self.distinct + 1)
        return np.log10((count[pair] + PRIOR * alone) / (count[of_before] + PRIOR)), of_token


def _scan(
    docs: DataFrame, row: str | None, model, part: tuple[int, int], cut: int
) -> DataFrame:
    """Sums over the positions of one pair of group parts, one row per document.

    ``model`` is a broadcast ``Model``; ``cut`` is the number of groups in a part. Without a
    column ``row`` that numbers the rows, they are numbered here.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = model.value
        norm = math.log10(known.total + known.distinct + 1)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for rows, found in chunks(batch.column(0)):
                tokens, before, borders = sequences(
                    Texts(found.data, found.offsets, lower=True)
                )
                text = np.repeat(np.arange(found.n), np.diff(borders))
                if cut < GROUPS:
                    own = (word_piece(before) // cut == part[0]) & (
                        word_piece(tokens) // cut == part[1]
                    )
                    tokens, before, text = tokens[own], before[own], text[own]
                    borders = np.searchsorted(text, np.arange(found.n + 1))
                logs, level = known.log10(before, tokens)
                counts, hot = known.known(tokens)
                # Of words that are neither hot nor in the filter, the count is 0.
                cold = ~hot & (level > 0)
                places = np.searchsorted(text[cold], np.arange(found.n + 1))
                words = tokens[cold].view(np.int64)
                piece = batch.slice(rows.start, found.n)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(3)
                        if row
                        else pa.array(np.arange(number, number + found.n)),
                        piece.column(1),
                        piece.column(2),
                        pa.array(np.diff(borders)),
                        pa.array(run_sums(counts > 0, borders)),
                        pa.array(run_sums(np.log10(counts + 1.0) - norm, borders)),
                        pa.array(run_sums(logs, borders)),
                        list_column(
                            [words[a:b] for a, b in zip(places, places[1:])], pa.int64()
                        ),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score",
                           "score", "cold"],
                )
                number += found.n

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["text", "doc_id", "held_out", *([row] if row else [])]
    return docs.select(*columns).mapInArrow(
        compute,
        f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, "
        "base_score double, score double, cold array<bigint>",
    )


def _number_rows(docs: DataFrame) -> DataFrame:
    """The documents as a written table whose rows have numbers that stay."""
    return store(docs.withColumn("row", F.monotonically_increasing_id()), "numbered-texts")


def _hot_words(pieces: DataFrame, levels: list[int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and exact counts of all words from the lowest level that fits."""
    lowest, words = len(levels), 0
    while lowest > 1 and words + levels[lowest - 1] <= most:
        lowest -= 1
        words += levels[lowest]
    at_least = F.lit(1 << (lowest - 1)).cast("long")
    hot = F.filter(F.arrays_zip("words", "counts"), lambda pair: pair["counts"] >= at_least)
    found = pieces.where(F.col("piece") < GROUPS).select(
        hot["words"].alias("words"), hot["counts"].alias("counts")
    )
    parts = [
        (np.array(words, dtype=np.int64), np.array(counts, dtype=np.int64))
        for words, counts in found.toLocalIterator()
    ]
    hashes = np.concatenate([np.zeros(0, np.int64), *[p[0] for p in parts]]).view(np.uint64)
    counts = np.concatenate([np.zeros(0, np.int64), *[p[1] for p in parts]])
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def _cut(sizes: dict[int, int], most: int) -> int:
    """Groups in a part, as many as keep the pieces of every pair of parts below ``most``."""
    cut = GROUPS
    while cut >= 1:
        parts = range(GROUPS // cut)
        if all(sum(sizes.get(p, 0) for p in _pieces(a, b, cut)) <= most
               for a in parts for b in parts):
            return cut
        cut //= 2
    raise ValueError(f"a filter piece exceeds {most} bytes: raise FILTER_BYTES")


def _pieces(a: int, b: int, cut: int) -> list[int]:
    """Pieces that positions of parts ``a`` and ``b`` probe."""
    first, second = range(a * cut, (a + 1) * cut), range(b * cut, (b + 1) * cut)
    pairs = [GROUPS + x * GROUPS + y for x in first for y in second]
    return sorted({*first, *second}) + pairs


def score_documents(
    docs: DataFrame,
    held_out: Column,
    filter_bytes: int | None = None,
    hot_words: int | None = None,
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row.

    Rows for which ``held_out`` is not true train the model; all rows are scored.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    # A task's n-grams spread over all pieces; more input partitions give more parts of each.
    parts = 1 + docs.rdd.getNumPartitions() // 256
    counted = _count_parts(docs.where("not held_out"), "text", parts)
    pieces = store(
        counted.groupBy("piece", "part").applyInPandas(_build, _PIECE_SCHEMA), "filter-pieces"
    )
    # A few hundred rows of numbers, more only with thousands of input partitions.
    sizes = pieces.groupBy("piece").agg(
        F.sum(F.octet_length("bits")).alias("bytes"),
        F.sum("distinct").alias("distinct"),
        F.sum("total").alias("total"),
        F.array(*[F.sum(F.col("levels")[i]) for i in range(LEVELS + 1)]).alias("levels"),
    )
    sizes = {row.piece: row for row in sizes.collect()}
    of_words = [row for piece, row in sizes.items() if piece < GROUPS]
    total = sum(row.total for row in of_words)
    distinct = sum(row.distinct for row in of_words)
    levels = [sum(row.levels[i] for row in of_words) for i in range(LEVELS + 1)]
    hot, counts = _hot_words(pieces, levels, HOT_WORDS if hot_words is None else hot_words)
    most = FILTER_BYTES if filter_bytes is None else filter_bytes
    cut = _cut({piece: row.bytes for piece, row in sizes.items()}, most)
    row = None
    if cut < GROUPS:
        docs, row = _number_rows(docs), "row"
    scans = []
    for a in range(GROUPS // cut):
        for b in range(GROUPS // cut):
            rows = pieces.where(F.col("piece").isin(_pieces(a, b, cut)))
            bits = [(p, q, bytes(x)) for p, q, x in
                    rows.select("piece", "part", "bits").toLocalIterator()]
            sent = spark.sparkContext.broadcast(
                Model(Filter(bits, parts), hot, counts, total, distinct)
            )
            # Written before the next part is sent, so that workers hold one part at a time.
            scans.append(store(_scan(docs, row, sent, (a, b), cut), "score-parts"))
            sent.unpersist()
    return _gathered(scans, pieces, total)


def _gathered(scans: list[DataFrame], pieces: DataFrame, total: int) -> DataFrame:
    """Sums of all scans, with the exact counts of the words left to look up."""
    scored = scans[0]
    for scan in scans[1:]:
        scored = scored.unionAll(scan)
    exact = pieces.where(F.col("piece") < GROUPS).select(
        F.explode(F.arrays_zip("words", "counts")).alias("entry")
    ).select(F.col("entry.words").alias("word"), F.col("entry.counts").alias("count"))
    # Each was scored with count 0, which log10(0 + 1) adds nothing for. Words that no
    # training text has are no rows here, however many rows of the scored texts hold them.
    asked = scored.select("row", F.explode("cold").alias("word")).groupBy("row", "word").agg(
        F.count(F.lit(1)).alias("n")
    )
    looked_up = asked.join(exact, "word").groupBy("row").agg(
        F.sum("n").alias("n_known"),
        F.sum(F.col("n") * F.log10(F.col("count") + 1)).alias("base_score"),
    )
    summed = scored.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.sum("base_score").alias("base_score"),
        F.sum("score").alias("score"),
    )
    both = summed.join(looked_up.withColumnsRenamed(
        {"n_known": "more_known", "base_score": "more_base"}), "row", "left")
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
