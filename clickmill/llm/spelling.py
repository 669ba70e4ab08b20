"""Spelling variants: each word with its commoner spelling one edit away.

Words are counted in the texts and near words found by scanning sorted lists. A scan carries
the banded rows of the edit matrix of a query (three cells, as one edit leaves the diagonal by
one at most) down a sorted list: between neighbours in the list, the rows of their common
prefix are used again, and where all cells of a row exceed one edit, the whole range that
shares this prefix is skipped. Many queries are scanned at once, as array work.

One edit leaves the first three letters or the last four as they are, for words of seven and
more. Pairs with the same first three are found in the sorted list of words, all others in the
sorted list of reversed words, so every pair is found once. Each list is cut into ranges of
about equal numbers of words, however many words share a prefix. A query goes to the ranges
whose words can share its first letters, less those whose common prefix already exceeds one
edit, found by the same scan over these prefixes. So no prefix group meets in one task, and no
range sees more than the words within an edit of its prefix.

Defined results: null and empty texts have no words; a null id counts as empty text before
the colon; repeated rows count each; words of any length are handled; further columns are not
read; an empty table gives no rows. Ties between forms go to the smaller word in code-point
order.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import store
from clickmill.llm.text import LOWER, chunks

LEAST_LETTERS = 7
LEAST_COUNT = 2
# A form is at least this many times as frequent as its variant.
FORM_TIMES = 10
# One run in this many has a letter deleted, by the CRC-32 of its id and text.
DELETE_ONE_IN = 31
# Letters that are equal in the pairs which the list of words, and of reversed words, finds.
EXACT = (3, 4)
# Words of a list's range, and queries that are scanned at once.
RANGE_WORDS = 1 << 14
SCAN_QUERIES = 1 << 13
SCAN_BYTES = 1 << 24
# Skips are looked up to this depth; below, entries are passed one by one.
SKIP_DEPTH = 64
# Words that a task collects before it hands on their counts.
HELD_WORDS = 1 << 18
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF, and of no other character
_FAR = 2


def _crc_table() -> np.ndarray:
    """The byte table of CRC-32 from its reversed polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ (np.uint32(0xEDB88320) * (table & 1))
    return table


_CRC = _crc_table()


# --- words of texts -------------------------------------------------------------------


def _run_crcs(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, begun: np.ndarray
) -> np.ndarray:
    """CRC-32 of each run, continued from the CRC-32 of what stands before it."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    state = ~begun[order]
    long = int(np.searchsorted(-lengths, -256, side="right"))
    for at in range(long):
        run = data[starts[at] : starts[at] + lengths[at]].tobytes()
        state[at] = ~np.uint32(zlib.crc32(run, int(~state[at])))
    longest = int(lengths[long]) if long < len(lengths) else 0
    for at in range(longest):
        some = slice(long, int(np.searchsorted(-lengths, -at, side="left")))
        low = (state[some] ^ data[starts[some] + at]) & np.uint32(0xFF)
        state[some] = _CRC[low] ^ (state[some] >> np.uint32(8))
    crcs = np.empty_like(state)
    crcs[order] = ~state
    return crcs


def words_of(ids: list, column: pa.Array) -> Iterator[pa.Array]:
    """Words of every piece of a column, in ISO 8859-1, with letters deleted as asked."""
    for rows, texts in chunks(column):
        data = LOWER[texts.data]
        lead = data == _LEAD
        follows = np.zeros_like(lead)
        follows[1:] = lead[:-1]
        letter = ((data >= ord("a")) & (data <= ord("z"))) | lead | follows
        border = np.zeros(len(data) + 1, dtype=bool)
        border[texts.offsets] = True
        before = np.ones_like(letter)
        before[1:] = ~letter[:-1]
        after = np.ones_like(letter)
        after[:-1] = ~letter[1:]
        starts = np.flatnonzero(letter & (before | border[:-1]))
        ends = np.flatnonzero(letter & (after | border[1:])) + 1
        leads = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(lead, out=leads[1:])
        letters = ends - starts - (leads[ends] - leads[starts])
        # Shorter runs give no word, with or without a deletion.
        whole = letters >= LEAST_LETTERS
        starts, ends, letters = starts[whole], ends[whole], letters[whole]
        prefixes = np.array(
            [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids[rows]], dtype=np.uint32
        )
        text = np.searchsorted(texts.offsets, starts, side="right") - 1
        crcs = _run_crcs(data, starts, ends - starts, prefixes[text])
        cut = crcs % DELETE_ONE_IN == 0
        one_byte = data + np.where(follows, np.uint8(0x40), np.uint8(0))
        marks = np.zeros(len(data) + 1, dtype=np.int8)
        marks[starts[~cut]] += 1
        marks[ends[~cut]] -= 1
        kept = one_byte[(np.cumsum(marks[:-1], dtype=np.int8) > 0) & ~lead]
        offsets = np.zeros(int((~cut).sum()) + 1, dtype=np.int64)
        np.cumsum(letters[~cut], out=offsets[1:])
        yield pa.Array.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
        )
        shorter = []
        for at in np.flatnonzero(cut & (letters > LEAST_LETTERS)).tolist():
            span = slice(starts[at], ends[at])
            run = one_byte[span][~lead[span]].tobytes()
            out = int(crcs[at]) % len(run)
            shorter.append(run[:out] + run[out + 1 :])
        yield pa.array(shorter, pa.large_binary())


def _counted(parts: list[pa.Table]) -> list[pa.Table]:
    summed = pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")])
    return [pa.table({"word": summed["word"], "n": summed["n_sum"]})]


def vocabulary(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(word, n)`` of all words that are long and frequent enough."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            for words in words_of(batch.column(0).to_pylist(), batch.column(1)):
                found = words.value_counts()
                held.append(pa.table({"word": found.field(0), "n": found.field(1)}))
                size += len(found)
                if size > 2 * HELD_WORDS:
                    held = _counted(held)
                    size = held[0].num_rows
                    if size > HELD_WORDS:
                        yield from held[0].cast(schema).to_batches(max_chunksize=HELD_WORDS)
                        held, size = [], 0
        if held:
            yield from _counted(held)[0].cast(schema).to_batches(max_chunksize=HELD_WORDS)

    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    found = docs.select(key, text).mapInArrow(compute, "word binary, n bigint")
    counts = found.groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT).select(
        F.decode("word", "ISO-8859-1").alias("word"), "n"
    )


# --- scans of sorted lists ------------------------------------------------------------


class SortedList:
    """Byte strings in order, with common prefixes of neighbours and the ends of ranges."""

    def __init__(self, entries: list[bytes]):
        self.n = len(entries)
        self.length = np.array([len(e) for e in entries], dtype=np.int64)
        self.start = np.zeros(self.n + 1, dtype=np.int64)
        np.cumsum(self.length, out=self.start[1:])
        self.flat = np.frombuffer(b"".join(entries) + b"\0", dtype=np.uint8)
        # Letters shared with the entry before; the end of the list shares none.
        self.common = np.full(self.n + 1, -1, dtype=np.int64)
        for at in range(1, self.n):
            a, b = entries[at - 1], entries[at]
            most = min(len(a), len(b))
            same = 0
            while same < most and a[same] == b[same]:
                same += 1
            self.common[at] = same
        depth = min(int(self.length.max(initial=0)), SKIP_DEPTH)
        # skip[i, d]: the next entry that differs from entry i in its first d + 1 letters.
        self.skip = np.empty((self.n, depth), dtype=np.int32)
        later = np.full(depth, self.n, dtype=np.int32)
        for at in range(self.n - 1, -1, -1):
            self.skip[at] = later
            later[max(int(self.common[at]), 0) :] = at

    def past(self, entry: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First later entry that does not share the first ``depth + 1`` letters."""
        known = depth < self.skip.shape[1]
        after = entry + 1
        after[known] = self.skip[entry[known], depth[known]]
        while True:
            inside = self.common[after] > depth
            if not inside.any():
                return after
            after[inside] += 1


def scan(
    queries: list[bytes],
    firsts: np.ndarray,
    lasts: np.ndarray,
    entries: SortedList,
    exact: int,
    whole: bool = True,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, entry) one edit apart behind ``exact`` equal letters.

    Query i is scanned against the entries from ``firsts[i]`` to before ``lasts[i]``, all of
    which share its first ``exact`` letters. If not ``whole``, pairs are those in which the
    entry is within one edit of some beginning of the query.
    """
    found_query, found_entry = [], []
    sizes = np.array([len(q) for q in queries], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        # Queries of like length; their rows and letters are bounded together.
        width = int(sizes[order[min(at + SCAN_QUERIES, len(order)) - 1]]) + 4
        some = max(1, min(SCAN_QUERIES, SCAN_BYTES // (4 * width)))
        block = order[at : at + some]
        width = int(sizes[block[-1]]) + 4
        pairs = _scan_block(
            [queries[i] for i in block], firsts[block], lasts[block], entries, exact, whole, width
        )
        found_query.append(block[pairs[0]])
        found_entry.append(pairs[1])
        at += some
    if not found_query:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_query), np.concatenate(found_entry)


def _scan_block(
    queries: list[bytes],
    firsts: np.ndarray,
    lasts: np.ndarray,
    entries: SortedList,
    exact: int,
    whole: bool,
    width: int,
) -> tuple[np.ndarray, np.ndarray]:
    count = len(queries)
    size = np.array([len(q) for q in queries], dtype=np.int64)
    # One letter that equals none before each query and at least two behind.
    letters = np.zeros((count, width), dtype=np.uint8)
    for at, q in enumerate(queries):
        letters[at, 1 : len(q) + 1] = np.frombuffer(q, dtype=np.uint8)
    letters = letters.ravel()
    # Row d of a query: cells d - 1, d and d + 1 of row d of its edit matrix.
    rows = np.full((count * width, 3), _FAR, dtype=np.uint8)
    rows[np.arange(count) * width + exact] = (_FAR, 0, 1)
    query = np.flatnonzero(firsts < lasts)
    entry = firsts[query].astype(np.int64)
    depth = np.full(len(query), exact, dtype=np.int64)
    hits_query, hits_entry = [], []
    while len(query):
        if not whole:
            # An entry that ends on rows known already is within one edit.
            done = depth == entries.length[entry]
            if done.any():
                hits_query.append(query[done])
                hits_entry.append(entry[done])
                entry[done] += 1
                depth[done] = np.minimum(entries.common[entry[done]], depth[done])
                going = (entry < lasts[query]) & (depth >= exact)
                query, entry, depth = query[going], entry[going], depth[going]
                continue
        at = query * width + depth
        p = rows[at]
        letter = entries.flat[entries.start[entry] + depth]
        left = size[query] - depth
        n = np.empty_like(p)
        n[:, 0] = np.minimum(p[:, 0] + (letter != letters[at]), p[:, 1] + 1)
        n[:, 1] = np.minimum(
            np.minimum(p[:, 1] + (letter != letters[at + 1]), p[:, 2] + 1), n[:, 0] + 1
        )
        n[:, 1][left < 1] = _FAR
        n[:, 2] = np.minimum(p[:, 2] + (letter != letters[at + 2]), n[:, 1] + 1)
        n[:, 2][left < 2] = _FAR
        n[:, 0][left < 0] = _FAR
        np.minimum(n, _FAR, out=n)
        alive = n.min(axis=1) < _FAR
        depth += 1
        ended = depth == entries.length[entry]
        rows[(query * width + depth)[alive]] = n[alive]
        if whole:
            # The query ends in cell 0, 1 or 2 of the entry's last row.
            last = np.flatnonzero(ended & (left >= 0) & (left <= 2))
            near = last[n[last, left[last]] == 1]
            hits_query.append(query[near])
            hits_entry.append(entry[near])
        elif (alive & ended).any():
            hits_query.append(query[alive & ended])
            hits_entry.append(entry[alive & ended])
        entry[alive & ended] += 1
        dead = ~alive
        entry[dead] = entries.past(entry[dead], depth[dead] - 1)
        moved = dead | ended
        depth[moved] = np.minimum(entries.common[entry[moved]], depth[moved])
        going = (entry < lasts[query]) & (depth >= exact)
        query, entry, depth = query[going], entry[going], depth[going]
    if not hits_query:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(hits_query), np.concatenate(hits_entry)


def _shared(a: bytes, b: bytes) -> bytes:
    same = 0
    while same < min(len(a), len(b)) and a[same] == b[same]:
        same += 1
    return a[:same]


class Ranges:
    """Which ranges of a sorted list can hold words near a query."""

    def __init__(self, bounds: list[tuple[int, bytes, bytes]], exact: int):
        bounds = sorted(bounds, key=lambda b: b[1])
        self.exact = exact
        self.number = np.array([b[0] for b in bounds], dtype=np.int32)
        self.low = [b[1] for b in bounds]
        self.high = [b[2] for b in bounds]
        # What the words of a range share behind the letters that are equal anyway.
        self.shared = SortedList([_shared(b[1], b[2])[exact:] for b in bounds])

    def of(self, queries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, range number)."""
        spans: dict[bytes, tuple[int, int]] = {}
        firsts, lasts = np.empty((2, len(queries)), dtype=np.int64)
        for at, q in enumerate(queries):
            prefix = q[: self.exact]
            if prefix not in spans:
                # Ranges that end at or above the prefix and begin at or below its last word.
                spans[prefix] = (
                    bisect_left(self.high, prefix),
                    bisect_right(self.low, prefix, key=lambda word: word[: self.exact]),
                )
            firsts[at], lasts[at] = spans[prefix]
        rest = [q[self.exact :] for q in queries]
        query, at = scan(rest, firsts, lasts, self.shared, 0, whole=False)
        return query, self.number[at]


# --- near words -----------------------------------------------------------------------


def _near_side(vocab: DataFrame, words: int, backward: bool) -> DataFrame:
    """``(word, n_near, best)`` from the list of words or of reversed words."""
    exact = EXACT[backward]
    key = F.reverse("word") if backward else F.col("word")
    ranges = max(math.ceil(words / RANGE_WORDS), 1)
    listed = (
        vocab.select(F.encode(key, "ISO-8859-1").alias("key"), "n")
        .repartitionByRange(ranges, "key")
        .sortWithinPartitions("key")
        .select(F.spark_partition_id().alias("range"), "key", "n")
    )
    listed = store(listed, "sorted-words")
    # Two words a range of thousands.
    bounds = listed.groupBy("range").agg(F.min("key"), F.max("key")).collect()
    borders = [(r, bytes(low), bytes(high)) for r, low, high in bounds]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Ranges(borders, exact)
        for batch in batches:
            query, number = known.of(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), batch.column(0).take(pa.array(query))], names=["range", "key"]
            )

    def match(entries: pa.Table, asked: pa.Table) -> pa.Table:
        return _match(entries, asked, exact, backward)

    routed = listed.select("key").mapInArrow(route, "range int, key binary")
    # A range is few bytes and much work: as many tasks as ranges, not as many as bytes ask for.
    return (
        listed.repartition(ranges, "range")
        .groupBy("range")
        .cogroup(routed.repartition(ranges, "range").groupBy("range"))
        .applyInArrow(match, "word string, n_near bigint, best_n bigint, best string")
    )


def _match(entries: pa.Table, asked: pa.Table, exact: int, backward: bool) -> pa.Table:
    entries = entries.sort_by("key")
    keys = entries["key"].to_pylist()
    counts = entries["n"].to_numpy()
    queries = asked["key"].to_pylist()
    prefixes = np.array([k[:exact] for k in keys], dtype=f"S{exact}")
    wanted = np.array([q[:exact] for q in queries], dtype=f"S{exact}")
    firsts = np.searchsorted(prefixes, wanted, side="left")
    lasts = np.searchsorted(prefixes, wanted, side="right")
    query, entry = scan(queries, firsts, lasts, SortedList(keys), exact)
    if backward:
        # Pairs with equal first letters were found in the list of words.
        front = np.array([k[::-1][: EXACT[0]] for k in keys], dtype=f"S{EXACT[0]}")
        own = np.array([q[::-1][: EXACT[0]] for q in queries], dtype=f"S{EXACT[0]}")
        other = own[query] != front[entry]
        query, entry = query[other], entry[other]

    def text(k: bytes) -> str:
        return (k[::-1] if backward else k).decode("latin-1")

    found = pa.table(
        {
            "query": pa.array(query),
            "minus": pa.array(-counts[entry]),
            "near": pa.array([text(keys[e]) for e in entry.tolist()], pa.string()),
        }
    ).sort_by([("query", "ascending"), ("minus", "ascending"), ("near", "ascending")])
    numbers = found["query"].to_numpy()
    first = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])[: len(numbers)])
    best = found.take(pa.array(first))
    return pa.table(
        {
            "word": pa.array([text(queries[q]) for q in numbers[first].tolist()], pa.string()),
            "n_near": pa.array(np.diff(np.append(first, len(numbers)))),
            "best_n": pc.negate(best["minus"]),
            "best": best["near"],
        }
    )


def near_words(vocab: DataFrame) -> DataFrame:
    """``(word, n_near, best_n, best)`` of the words that have near words."""
    words = vocab.count()
    sides = _near_side(vocab, words, False).unionByName(_near_side(vocab, words, True))
    first = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best")))
    return sides.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", (-F.col("first.minus")).alias("best_n"), F.col("first.best").alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form, by doubling the steps that each has gone.

    A form is ten times as frequent as its variant, so chains are short and end.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        steps = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = store(
            roots.join(steps, "root", "left").select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "word-roots",
        )
        moved = roots.where("moved").limit(1).count()
        roots = roots.select("word", "root")
        if not moved:
            return roots


def group_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per word."""
    vocab = store(vocabulary(docs, key, text), "vocabulary")
    near = near_words(vocab)
    better = F.col("best_n") >= FORM_TIMES * F.col("n")
    formed = store(
        vocab.join(near, "word", "left").select(
            "word",
            F.when(better, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(better, F.col("best_n")).alias("form_n"),
        ),
        "word-forms",
    )
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


_LETTERS = r"[A-Za-z\x{00C0}-\x{00FF}]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL = f"""
with recursive byte_crc as (
    select list(list_reduce([c] || range(8),
        lambda acc, i: xor(acc >> 1, 3988292384 * (acc & 1))) order by c) as t
    from (select unnest(range(256)) as c)),
runs as (
    select coalesce(doc_id::varchar, '') as id,
        unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{_LETTERS}'))
            as run
    from documents),
counted as (
    select id, run, count(*) as n from runs where length(run) >= {LEAST_LETTERS} group by all),
hashed as (
    select run, n, xor(4294967295, list_reduce(
        [4294967295::bigint] || flatten(list_transform(string_split(id || ':' || run, ''),
            lambda c: case when unicode(c) < 128 then [unicode(c)::bigint]
                else [195::bigint, (unicode(c) - 64)::bigint] end)),
        lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1]))) as h
    from counted, byte_crc),
vocab as (
    select word, sum(n)::bigint as n from (
        select n, case when h % {DELETE_ONE_IN} = 0
            then run[1 : h % length(run)] || run[h % length(run) + 2 : ] else run end as word
        from hashed)
    where length(word) >= {LEAST_LETTERS} group by word having sum(n) >= {LEAST_COUNT}),
cuts as (
    select word, n, pos, word[1 : pos - 1] || word[pos + 1 : ] as rest
    from (select word, n, unnest(range(1, length(word) + 1)) as pos from vocab)),
near as (
    select a.word, b.word as other, b.n
    from cuts as a join cuts as b on a.rest = b.rest and a.pos = b.pos and a.word <> b.word
    union
    select a.word, b.word, b.n from cuts as a join vocab as b on a.rest = b.word
    union
    select b.word, a.word, a.n from cuts as a join vocab as b on a.rest = b.word),
best as (
    select word, count(*) as n_near, (list({{'form': other, 'n': n}} order by n desc, other))[1] as f
    from near group by word),
formed as (
    select word, vocab.n, coalesce(n_near, 0)::bigint as n_near,
        case when f.n >= {FORM_TIMES} * vocab.n then f.form end as form,
        case when f.n >= {FORM_TIMES} * vocab.n then f.n end as form_n
    from vocab left join best using (word)),
walk as (
    select word, word as reached from formed
    union all
    select walk.word, formed.form from walk join formed on formed.word = walk.reached
    where formed.form is not null)
select formed.word, formed.form, walk.reached as root, formed.n, formed.n_near, formed.form_n
from formed join walk using (word) join formed as last on last.word = walk.reached
where last.form is null
"""
