"""Approximate nearest neighbours by inner product: adaptive dimension scan in probed lists.

Vectors are dealt into lists by their nearest centroid. A query scans its nearest lists. In a
list, vectors and queries are rotated by one random orthogonal matrix and compared in blocks
of columns. After each block a test asks whether the distance seen so far, scaled to all
columns, is too large for the candidate to reach the query's threshold; what fails by more
than chance allows is abandoned. Survivors are scored in double precision on the original
vectors. The threshold of a query is its k-th best score among the sample,
then that of its nearest list, and it rises with what a list yields. The sample gives thresholds
only, no answers. A query for which the probed lists yield fewer than it asks for is searched in
all lists again, where a candidate is abandoned only if it cannot reach the threshold at all.

Fitted on a sample of at most ``SAMPLE`` distinct vectors (drawn by a hash): centroids, the
number of lists to probe (enough for ``PROBE_SHARE`` of the sample's own neighbours) and the
first thresholds. Every vector is indexed, and every query is answered.

Equal vectors are one candidate with its ``k + 1`` smallest ids, which is all that a result of
``k`` can hold of them, and equal queries are searched once. Lists are cut into parts of
``PART_BYTES``, so a list that holds a third of all vectors is scanned by many tasks. A vector
crosses the shuffle once per part of its list's queries (32,768 of 64 columns).

Defined results: vectors that are null, zero, of another than the most frequent length, or
hold null or non-finite components take no part; ties go to the smaller id; queries with
fewer than k candidates get all there are; rows with a null id take no part; repeated ids
count as rows of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import array_column, bounded_broadcast, store

SAMPLE = 16_384
VECTORS_PER_LIST = 2_000
MAX_LISTS = 1_024
PROBE_SHARE = 0.98
COLUMNS = 16
# Standard errors by which the scaled distance must miss before a candidate is abandoned.
SIGNIFICANCE = 2.5
# Vectors, and queries, that a task holds at once, and those it compares at once.
PART_BYTES = 16 << 20
VECTOR_BLOCK, QUERY_BLOCK = 2_048, 512
_PAIRS = 1 << 17


def usable(vectors: DataFrame) -> DataFrame:
    """``id`` and ``v`` (array of double) of the vectors that take part."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = rows.filter(finite & F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), "length").limit(1).collect()
    return rows.filter(F.size("v") == (most[0]["length"] if most else 0))


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """``rep``, ``v`` and the ``k + 1`` smallest ``ids`` of each distinct vector."""
    first = Window.partitionBy("h1", "h2").orderBy("id")
    few = rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
    return few.groupBy("h1", "h2").agg(
        F.min("id").alias("rep"),
        F.min_by("v", "id").alias("v"),
        F.sort_array(F.collect_list("id")).alias("ids"),
    )


class Index:
    """Centroids, rotation, probes per query and the sample that thresholds start from."""

    def __init__(self, sample: np.ndarray, total: int, k: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        dims = sample.shape[1]
        self.k = k
        self.rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        lists = int(np.clip(total // VECTORS_PER_LIST, 1, min(MAX_LISTS, len(sample))))
        centres = sample[rng.choice(len(sample), lists, replace=False)].copy()
        for _ in range(8):
            own = self._nearest(sample, centres)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, sample)
            counts = np.bincount(own, minlength=lists)
            centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
        self.centres = centres
        self.probes = self._enough_probes(sample, rng)
        self.sample = sample

    @staticmethod
    def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.argmin((centres**2).sum(axis=1) - 2 * x @ centres.T, axis=1)

    def list_of(self, x: np.ndarray) -> np.ndarray:
        return self._nearest(x, self.centres)

    def ranked_lists(self, q: np.ndarray) -> np.ndarray:
        return np.argsort(-(q @ self.centres.T), axis=1, kind="stable")

    def _enough_probes(self, sample: np.ndarray, rng: np.random.Generator) -> int:
        """Lists that hold the wanted share of the sample's neighbours within the sample."""
        chosen = rng.choice(len(sample), min(256, len(sample)), replace=False)
        q = sample[chosen]
        scores = q @ sample.T
        scores[np.arange(len(q)), chosen] = -np.inf
        near = np.argsort(-scores, axis=1)[:, : self.k]
        place = np.argsort(self.ranked_lists(q), axis=1)
        ranks = np.take_along_axis(place, self.list_of(sample)[near], axis=1)
        return int(np.quantile(ranks, PROBE_SHARE, method="higher")) + 1

    def first_thresholds(self, q: np.ndarray) -> np.ndarray:
        """Score that the k best other vectors reach at least, as far as the sample tells."""
        least = np.full(len(q), -np.inf)
        if len(self.sample) > self.k:
            for i in range(0, len(q), 128):
                scores = q[i : i + 128] @ self.sample.T
                least[i : i + 128] = np.partition(scores, -self.k - 1, axis=1)[:, -self.k - 1]
        return least - 1e-9 * (1 + np.abs(least, where=np.isfinite(least), out=np.zeros(len(q))))


def scan(
    q: np.ndarray, x: np.ndarray, least: np.ndarray, rotation: np.ndarray, sure: bool = False
):
    """Pairs (query, vector) whose inner product may reach the query's ``least``, and scores.

    Compares ``COLUMNS`` rotated dimensions at a time and abandons hopeless pairs between; if
    ``sure``, only pairs whose distance so far is too large already.
    """
    with np.errstate(invalid="ignore", over="ignore"):
        return _scan(q, x, least, rotation, sure)


def _scan(q: np.ndarray, x: np.ndarray, least: np.ndarray, rotation: np.ndarray, sure: bool):
    dims = q.shape[1]
    rq, rx = q @ rotation, x @ rotation
    q2, x2 = rq**2, rx**2
    all_q, all_x = q2.sum(axis=1), x2.sum(axis=1)
    inner = np.zeros((len(q), len(x)))
    alive = np.ones(inner.shape, dtype=bool)
    seen = 0
    while seen < dims and alive.any():
        step = slice(seen, min(seen + COLUMNS, dims))
        columns = np.flatnonzero(alive.any(axis=0))
        if len(columns) == len(x):
            inner += rq[:, step] @ rx[:, step].T
        else:
            inner[:, columns] += rq[:, step] @ rx[columns, step].T
        seen = step.stop
        if seen < dims:
            slack = 1 + SIGNIFICANCE * np.sqrt((1 - seen / dims) / seen)
            most = 1.0 if sure else slack**2 * seen / dims
            # A pair's distance so far is above ``most`` times the distance at which its product
            # is ``least`` where its product so far is below a sum of one term of the query and
            # one of the vector. A share for rounding keeps what is equal to the threshold.
            of_q = (q2[:, :seen].sum(axis=1) - (most + 1e-9) * all_q) / 2 + most * least
            of_x = (x2[:, :seen].sum(axis=1) - (most + 1e-9) * all_x) / 2
            # Not the opposite comparison: what is no number after an overflow stays.
            alive &= ~(inner < of_q[:, None] + of_x[None, :])
    alive &= ~(inner < (least - 1e-9 * (1 + np.abs(least)))[:, None])
    at_q, at_x = np.nonzero(alive)
    scores = np.empty(len(at_q))
    for i in range(0, len(at_q), _PAIRS):
        part = slice(i, i + _PAIRS)
        scores[part] = (q[at_q[part]] * x[at_x[part]]).sum(axis=1)
    return at_q, at_x, scores


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def best_of_part(
    q: np.ndarray,
    x: np.ndarray,
    rep: np.ndarray,
    least: np.ndarray,
    rotation: np.ndarray,
    keep: int,
    sure: bool = False,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query's place, vector's ``rep`` and score of each query's ``keep`` best, block by block.

    A query that has found ``keep`` asks of later blocks to beat the last of them.
    """
    found = []
    for i in range(0, len(q), QUERY_BLOCK):
        own = q[i : i + QUERY_BLOCK]
        lowest = least[i : i + QUERY_BLOCK].copy()
        at, name, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for j in range(0, len(x), VECTOR_BLOCK):
            at_q, at_x, scores = scan(own, x[j : j + VECTOR_BLOCK], lowest, rotation, sure)
            at = np.concatenate([at, at_q])
            name = np.concatenate([name, rep[j : j + VECTOR_BLOCK][at_x]])
            score = np.concatenate([score, scores])
            order = np.lexsort((name, -score, at))
            order = order[np.arange(len(order)) - np.searchsorted(at[order], at[order]) < keep]
            at, name, score = at[order], name[order], score[order]
            last = np.arange(len(at)) - np.searchsorted(at, at) == keep - 1
            lowest[at[last]] = np.maximum(lowest[at[last]], score[last])
        found.append((at + i, name, score))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _scan_groups(queries: DataFrame, vectors: DataFrame, index: Index, sure: bool) -> DataFrame:
    """Best ``k + 1`` of each query in each list part: ``query``, ``rep`` and ``score``."""
    keep, rotation = index.k + 1, index.rotation

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(left) and len(right):
            # In the order of ids, so that thresholds rise alike in every run.
            left, right = left.sort_by("query"), right.sort_by("rep")
            at, rep, score = best_of_part(
                _matrix(left["v"]),
                _matrix(right["v"]),
                right["rep"].to_numpy(),
                left["least"].to_numpy(),
                rotation,
                keep,
                sure,
            )
            found = [left["query"].to_numpy()[at], rep, score]
        return pa.table(dict(zip(("query", "rep", "score"), map(pa.array, found), strict=True)))

    keys = ["list", "vpart", "qpart"]
    return (
        queries.groupBy(*keys)
        .cogroup(vectors.groupBy(*keys))
        .applyInArrow(compare, "query long, rep long, score double")
    )


def _parts(sizes: DataFrame, part: int, name: str) -> DataFrame:
    return sizes.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / part).alias(name))


def _search(queries: DataFrame, vectors: DataFrame, index: Index, sure: bool = False) -> DataFrame:
    """Compare queries (``query``, ``v``, ``least``, ``list``) with the vectors of their lists."""
    rows = max(1, PART_BYTES // (8 * index.rotation.shape[0]))
    parts = _parts(vectors, rows, "vparts").join(_parts(queries, rows, "qparts"), "list")
    parts = bounded_broadcast(store(parts, "ann-parts"), 24)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    q = queries.join(parts, "list").select(
        "list",
        F.pmod(F.xxhash64("query"), F.col("qparts")).alias("qpart"),
        every("vparts").alias("vpart"),
        "query",
        "least",
        "v",
    )
    x = vectors.join(parts, "list").select(
        "list",
        F.pmod(F.xxhash64("rep"), F.col("vparts")).alias("vpart"),
        every("qparts").alias("qpart"),
        "rep",
        "v",
    )
    return _scan_groups(q, x, index, sure)


def _assigned(vectors: DataFrame, index: Index) -> DataFrame:
    def compute(batches):
        for batch in batches:
            lists = index.list_of(_matrix(batch.column(1))) if len(batch) else np.zeros(0)
            columns = [pa.array(lists.astype(np.int32)), batch.column(0), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, ["list", "rep", "v"])

    return vectors.select("rep", "v").mapInArrow(compute, "list int, rep long, v array<double>")


def _probing(queries: DataFrame, index: Index) -> DataFrame:
    """One row per query: its first threshold and all lists, nearest first."""

    def compute(batches):
        for batch in batches:
            q = _matrix(batch.column(1)) if len(batch) else np.zeros((0, len(index.rotation)))
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(index.first_thresholds(q)),
                array_column(index.ranked_lists(q).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["query", "v", "least", "lists"])

    return queries.select(F.col("rep").alias("query"), "v").mapInArrow(
        compute, "query long, v array<double>, least double, lists array<int>"
    )


def _in_lists(probing: DataFrame, start: int, n: int) -> DataFrame:
    """Queries with each of the ``n`` lists from ``start`` (0 is the nearest)."""
    return probing.select("query", "v", "least", F.explode(F.slice("lists", start + 1, n)).alias("list"))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k nearest found of each query.

    ``is_query`` marks the queries among the rows of ``vectors`` (``vec_id``, ``embedding``);
    it reads the id as ``id``.
    """
    rows = usable(vectors).withColumns({"h1": F.xxhash64("v"), "h2": F.hash("v")})
    rows = store(rows, "ann-rows")
    table = store(_distinct(rows, k), "ann-distinct")
    total = table.count()
    if not total:
        none = "query_id long, rank int, vec_id long, score double"
        return vectors.sparkSession.createDataFrame([], none)
    share = min(1.0, 0.9 * SAMPLE / total)
    drawn = F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(1 << 20)) < int(share * (1 << 20))
    sample = table.filter(drawn | (F.lit(share) == 1)).select("rep", "v").limit(SAMPLE).toArrow()
    sample = sample if len(sample) else table.select("rep", "v").limit(SAMPLE).toArrow()
    order = np.argsort(sample["rep"].to_numpy())
    index = Index(_matrix(sample["v"])[order], total, k)

    lists = store(_assigned(table, index), "ann-lists")
    asked = rows.filter(is_query).select(F.col("id").alias("query_id"), "h1", "h2")
    asked = store(
        asked.join(table.select("h1", "h2", "rep"), ["h1", "h2"]).select("query_id", "rep"),
        "ann-queries",
    )
    wanted = table.join(asked.select("rep").distinct(), "rep", "left_semi")
    probing = store(_probing(wanted, index), "ann-probes")
    home = store(_best(_search(_in_lists(probing, 0, 1), lists, index), k), "ann-home")
    # With k + 1 found in the nearest list, the last of them is the threshold elsewhere.
    raised = home.filter(F.col("place") == k + 1).select(
        "query", (F.col("score") - 1e-9 * (1 + F.abs("score"))).alias("reached")
    )
    others = _in_lists(probing, 1, index.probes - 1).join(raised, "query", "left").withColumn(
        "least", F.greatest("least", "reached")
    )
    found = home.drop("place").union(_search(others, lists, index))
    found = store(_best(found, k).select("query", "rep", "score"), "ann-found")
    if total > k:
        full = found.groupBy("query").count().filter(F.col("count") > k)
        short = store(probing.join(full, "query", "left_anti"), "ann-short")
        if not short.isEmpty():
            # Its first threshold cuts off none of the k + 1 best.
            rest = _search(_in_lists(short, 0, len(index.centres)), lists, index, sure=True)
            found = found.union(rest).groupBy("query", "rep").agg(F.max("score").alias("score"))
    best = _best(found, k).select("query", "rep", "score")
    ids = best.join(table.select("rep", "ids"), "rep").select(
        "query", "score", F.explode("ids").alias("vec_id")
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ids = ids.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    answers = ids.groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near")
    )
    answers = store(answers, "ann-answers")
    mine = asked.join(answers, F.col("rep") == F.col("query"))
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    named = mine.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "hit"))
    return named.select(
        "query_id",
        (F.col("at") + 1).alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        F.col("hit.score").alias("score"),
    )
