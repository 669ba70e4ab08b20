"""Best-fit packing of documents into bins, with conflicts between sources and copies.

A bin holds at most ``capacity`` words, no two documents of one duplicate cluster, and at
most ``per_source`` documents of one source. Bins are kept by residual space and carry two
bitmaps: sources that are full, and duplicate clusters that are present. A document, largest
first, goes to the tightest bin that can take it: the search starts at the residual that just
fits and goes on through the next larger residuals until a compatible bin is found. Only if
there is none a bin is opened. No bin of its group is passed over.

Documents longer than a bin are cut into full pieces with a bin each and a last piece that is
packed like any other. Spark deals the documents, by a hash of their ids, into groups of
about ``GROUP_ROWS`` and packs each group in one task; a group carries lengths, ids and bits,
never texts. The dealing spreads hot sources and clusters evenly over all groups, and rows of an
id (or of null) that repeats more than ``REPEATS`` times by their number in the table as well.
What groups lose at their borders is packed again: bins less than ``FULL_SHARE`` full are
emptied, and their pieces are dealt into groups anew, until one group holds all that is left or
a round leaves more than half of its pieces in such bins.

Defined results: documents without words need no bin and get none (null ``bin``); null
sources are one source; repeated rows are packed like copies; an empty table gives no rows;
texts of any length are counted whole; equal sizes go by cluster, then id, equal residuals by
the time a bin reached them; extra columns are passed over.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import bounded_broadcast, store
from clickmill.llm.mixing import word_count

CAPACITY = 2048
PER_SOURCE = 4
GROUP_ROWS = 4096
REPEATS = 64
FULL_SHARE = 0.98


class Bins:
    """Open bins of one group, ordered by residual space."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity = capacity
        self.per_source = per_source
        self.at_residual: list[list[int]] = [[] for _ in range(capacity + 1)]
        # Bit r is set if some bin has residual r.
        self.residuals = 0
        self.full_sources: list[int] = []
        self.clusters: list[int] = []
        self.source_counts: list[dict[int, int]] = []

    def _tightest(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Smallest residual with a compatible bin, and the place of the bin there."""
        above = self.residuals >> size
        residual = size
        while above:
            step = (above & -above).bit_length() - 1
            residual += step
            above >>= step
            for place, b in enumerate(self.at_residual[residual]):
                if not (self.full_sources[b] >> source & 1 or self.clusters[b] >> cluster & 1):
                    return residual, place
            residual += 1
            above >>= 1
        return -1, -1

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin of a document and the words before it there."""
        residual, place = self._tightest(size, source, cluster)
        if residual < 0:
            b, residual = len(self.clusters), self.capacity
            self.full_sources.append(0)
            self.clusters.append(0)
            self.source_counts.append({})
        else:
            held = self.at_residual[residual]
            b = held.pop(place)
            if not held:
                self.residuals ^= 1 << residual
        self.clusters[b] |= 1 << cluster
        counts = self.source_counts[b]
        counts[source] = counts.get(source, 0) + 1
        if counts[source] >= self.per_source:
            self.full_sources[b] |= 1 << source
        left = residual - size
        if left:
            self.at_residual[left].append(b)
            self.residuals |= 1 << left
        return b, self.capacity - residual


def pack_group(rows: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """Pieces of the documents of one group with their bins and the words that these hold.

    ``piece`` of a row is the number of its first piece.
    """
    rows = rows.sort_values(["size", "cluster", "doc_id"], ascending=[False, True, True])
    rows = rows.reset_index(drop=True)
    source, _ = pd.factorize(rows["source"], use_na_sentinel=False)
    cluster, _ = pd.factorize(rows["cluster"], use_na_sentinel=False)
    sizes = rows["size"].to_numpy()
    full, last = sizes // capacity, sizes % capacity
    whole = int(full.sum())
    at = np.repeat(np.arange(len(rows)), full)
    bins = Bins(capacity, per_source)
    order = np.argsort(-last, kind="stable")
    order = order[last[order] > 0]
    placed = [bins.put(int(last[i]), int(source[i]), int(cluster[i])) for i in order.tolist()]
    own, start = np.array(placed, dtype=np.int64).reshape(-1, 2).T
    held = np.bincount(own, weights=last[order], minlength=1).astype(np.int64)
    empty = np.flatnonzero(sizes == 0)
    none = np.zeros(len(empty), dtype=np.int64)
    columns = {
        "piece": [np.arange(whole) - np.repeat(np.cumsum(full) - full, full), full[order], none],
        "n_words": [np.full(whole, capacity), last[order], none],
        "bin": [np.arange(whole), own + whole, none],
        "start": [np.zeros(whole, dtype=np.int64), start, none],
        # Words in the bin; what needs no bin counts as full.
        "held": [np.full(whole, capacity), held[own], none + capacity],
    }
    made = pd.DataFrame({k: np.concatenate(v).astype(np.int64) for k, v in columns.items()})
    made["bin"] = made["bin"].astype("Int64").mask(made["n_words"] == 0)
    rows = rows.iloc[np.concatenate([at, order, empty])].reset_index(drop=True)
    made["piece"] += rows["piece"]
    return pd.concat([rows[["doc_id", "source", "cluster", "group"]], made], axis=1)


PACKED = (
    "doc_id string, source string, cluster long, group long, piece long, n_words long, bin long, "
    "start long, held long"
)


def text_cluster(text: str) -> Column:
    """Cluster of texts that are equal but for case and white space."""
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+", " ")
    return F.xxhash64(F.trim(plain))


def pack_documents(
    docs: DataFrame,
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
) -> DataFrame:
    """``doc_id``, ``piece``, ``n_words``, ``bin`` and ``start`` in the bin, one row per piece.

    ``cluster`` names the duplicate cluster of a document; without it, texts that are equal
    but for case and white space are one cluster.
    """
    rows = docs.select(
        # As text, because pandas has no integers beside nulls.
        F.col("doc_id").cast("string"),
        F.col("source").cast("string"),
        word_count("text").alias("size"),
        (text_cluster("text") if cluster is None else cluster).cast("long").alias("cluster"),
        F.lit(0).cast("long").alias("piece"),
        F.monotonically_increasing_id().alias("number"),
    )
    rows = store(rows, "packing-rows")
    hot = rows.groupBy("doc_id").count().filter(F.col("count") > REPEATS).select(
        F.col("doc_id").alias("hot_id"), F.lit(True).alias("hot")
    )
    hot = bounded_broadcast(store(hot, "packing-hot"), 64)
    rows = rows.join(hot, F.col("doc_id").eqNullSafe(F.col("hot_id")), "left").withColumn(
        "deal", F.xxhash64("doc_id", F.when(F.col("hot"), F.col("number")))
    )
    done, turn, n = None, 0, rows.count()
    while True:
        groups = max(1, -(-n // GROUP_ROWS))
        # Another dealing in each round.
        dealt = rows.withColumn("group", F.pmod(F.xxhash64("deal", F.lit(turn)), F.lit(groups)))
        packed = (
            dealt.select("doc_id", "source", "size", "cluster", "piece", "group")
            .groupBy("group")
            .applyInPandas(lambda group: pack_group(group, capacity, per_source), PACKED)
        )
        number = F.lit(turn << 58) + F.col("group") * F.lit(1 << 32) + F.col("bin")
        packed = store(packed.withColumn("bin", number), "packing-bins")
        poor = packed.filter(F.col("held") < FULL_SHARE * capacity)
        left = poor.count() if groups > 1 else 0
        again = 0 < left <= n / 2
        kept = packed.filter(F.col("held") >= FULL_SHARE * capacity) if again else packed
        done = kept if done is None else done.union(kept)
        if not again:
            return done.select(F.col("doc_id").cast("long"), "piece", "n_words", "bin", "start")
        # Pieces of a bin may be of one id; their bin and place there tell them apart.
        rows = poor.select(
            "doc_id", "source", F.col("n_words").alias("size"), "cluster", "piece",
            F.xxhash64("doc_id", "bin", "start").alias("deal"),
        )
        turn, n = turn + 1, left
