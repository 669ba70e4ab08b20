"""Centroid clustering by bit planes and population counts.

Components become integers, floor(scale * x). Every vector of 64 of them is packed into one
64-bit word a bit plane: bit c of plane i is bit i of component c in two's complement, so
plane i weighs 2^i and the highest plane, which holds the signs, minus that. A component is
the weighted sum of its bits, hence

    v . c = sum over planes i, j of weight_i * weight_j * popcount(V_i AND C_j)

and |v - c|^2 = |v|^2 + |c|^2 - 2 v . c, both in exact integers. Vectors are packed once and
written as planes; rounds read the planes only. A round sends one row a cluster and batch of
counts and component sums, summed by Spark; the driver sees one number per centroid
component.

Defined results: vectors that are null, have not exactly 64 components, or hold a null or
non-finite one take no part; further columns are not read. Repeated rows are vectors of
their own; rows without an id come last among the starting centroids, and equal ids are told
apart by their components. Fewer vectors than centroids give that many centroids; an empty
table gives no rows. Ties go to the smaller centroid number. Components beyond 2^27 after
scaling stop the job with a message: their squared distances need not fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import array_column, list_column, store

DIMS = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
MAX_BITS = 28
# Rows whose planes are compared with all centroids in one round of array work.
BLOCK_ROWS = 4096


def _bits_needed(values: np.ndarray) -> int:
    """Two's complement bits that hold all of ``values``."""
    if not values.size:
        return 1
    most = max(int(values.max()), -int(values.min()) - 1)
    return most.bit_length() + 1


def pack_planes(values: np.ndarray) -> np.ndarray:
    """Planes of rows of 64 integers: one 64-bit word a row and bit, lowest bit first."""
    planes = np.empty((len(values), _bits_needed(values)), dtype=np.uint64)
    for bit in range(planes.shape[1]):
        ones = ((values >> bit) & 1).astype(np.uint8)
        planes[:, bit] = np.packbits(ones, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return planes


def unpack_planes(planes: np.ndarray) -> np.ndarray:
    """The rows of 64 integers behind ``pack_planes``."""
    total = np.zeros((len(planes), DIMS), dtype=np.int64)
    for bit, weight in enumerate(plane_weights(planes.shape[1])):
        words = np.ascontiguousarray(planes[:, bit : bit + 1]).view(np.uint8)
        total += weight * np.unpackbits(words, axis=1, bitorder="little").astype(np.int64)
    return total


def plane_weights(bits: int) -> list[int]:
    return [1 << i for i in range(bits - 1)] + [-(1 << (bits - 1))]


def dot_products(planes: np.ndarray, centroid_planes: np.ndarray) -> np.ndarray:
    """Exact dot products of all rows with all centroids, from their planes."""
    dots = np.zeros((len(planes), len(centroid_planes)), dtype=np.int64)
    for i, wide in enumerate(plane_weights(planes.shape[1])):
        for j, high in enumerate(plane_weights(centroid_planes.shape[1])):
            common = planes[:, i, None] & centroid_planes[None, :, j]
            dots += (wide * high) * np.bitwise_count(common).astype(np.int64)
    return dots


def nearest_centroids(
    planes: np.ndarray, norms: np.ndarray, centroids: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row and its squared distance."""
    packed = pack_planes(centroids)
    own = (centroids * centroids).sum(axis=1)
    cluster = np.empty(len(planes), dtype=np.int32)
    distance = np.empty(len(planes), dtype=np.int64)
    for first in range(0, len(planes), BLOCK_ROWS):
        rows = slice(first, first + BLOCK_ROWS)
        away = norms[rows, None] + own[None, :] - 2 * dot_products(planes[rows], packed)
        cluster[rows] = away.argmin(axis=1)
        distance[rows] = away.min(axis=1)
    return cluster, distance


def _plane_matrix(column: pa.Array) -> np.ndarray:
    """Plane lists of different lengths as one matrix; the sign plane fills up the shorter."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    bits = np.diff(offsets)
    at = np.minimum(np.arange(bits.max(initial=1))[None, :], bits[:, None] - 1)
    return values[offsets[:-1, None] + at]


def pack_vectors(vectors: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``(key, planes, norm)`` of every vector that takes part."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Null components become NaN.
            full = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), DIMS), False)
            keys = batch.column(0).filter(full)
            flat = pc.list_flatten(batch.column(1).filter(full)).cast(pa.float64())
            x = flat.to_numpy(zero_copy_only=False).reshape(-1, DIMS)
            usable = np.isfinite(x).all(axis=1)
            # The product may overflow, which the test below finds.
            with np.errstate(over="ignore"):
                scaled = np.floor(x[usable] * scale)
            if scaled.size and np.abs(scaled).max() > 1 << (MAX_BITS - 1):
                raise ValueError(f"a component times {scale} is beyond 2^{MAX_BITS - 1}")
            values = scaled.astype(np.int64)
            planes = pack_planes(values).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    keys.filter(pa.array(usable)),
                    array_column(planes),
                    pa.array((values * values).sum(axis=1)),
                ],
                names=[key, "planes", "norm"],
            )

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.select(key, vector).mapInArrow(
        compute, f"`{key}` {kind}, planes array<bigint>, norm bigint"
    )


def _first_centroids(packed: DataFrame, key: str, count: int) -> np.ndarray:
    """The vectors of smallest hash of their id; equal ids in order of their components."""
    # The hash is null without an id, and null comes last.
    token = F.sha2(F.concat(F.lit("1:"), F.col(key).cast("string")), 256)
    rows = packed.select(token.alias("token"), "planes")
    # Equal ids are rare, so their components are compared by the planes as they are.
    rows = rows.orderBy(F.asc_nulls_last("token"), F.size("planes"), "planes").limit(count)
    lists = [np.array(row.planes, dtype=np.int64) for row in rows.collect()]
    matrix = _plane_matrix(list_column(lists, pa.int64()))
    return unpack_planes(matrix) if lists else np.zeros((0, DIMS), dtype=np.int64)


def _cluster_sums(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(cluster, size, sums)``, reduced within every batch."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            planes = _plane_matrix(batch.column(0))
            cluster, _ = nearest_centroids(planes, batch.column(1).to_numpy(), centroids)
            found, inverse = np.unique(cluster, return_inverse=True)
            sums = np.zeros((len(found), DIMS), dtype=np.int64)
            np.add.at(sums, inverse, unpack_planes(planes))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found),
                    pa.array(np.bincount(inverse)),
                    array_column(sums),
                ],
                names=["cluster", "size", "sums"],
            )

    return packed.select("planes", "norm").mapInArrow(
        compute, "cluster int, size bigint, sums array<bigint>"
    )


def _moved(packed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the exact floor of the mean, or as before if empty."""
    parts = _cluster_sums(packed, centroids)
    sums = parts.groupBy("cluster").agg(
        F.sum("size").alias("size"),
        *[F.sum(F.col("sums")[at]).alias(f"s{at}") for at in range(DIMS)],
    )
    moved = centroids.copy()
    for row in sums.collect():
        moved[row.cluster] = [row[f"s{at}"] // row["size"] for at in range(DIMS)]
    return moved


def _assigned(packed: DataFrame, key: str, centroids: np.ndarray) -> DataFrame:
    """``(key, cluster, distance)`` under fixed centroids."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cluster, distance = nearest_centroids(
                _plane_matrix(batch.column(1)), batch.column(2).to_numpy(), centroids
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster), pa.array(distance)],
                names=[key, "cluster", "distance"],
            )

    kind = packed.schema[key].dataType.simpleString()
    return packed.mapInArrow(compute, f"`{key}` {kind}, cluster int, distance bigint")


def cluster_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """``(key, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per vector."""
    spark = vectors.sparkSession
    packed = store(pack_vectors(vectors, key, vector, scale), "bit-planes")
    centroids = _first_centroids(packed, key, count)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(packed, centroids)
    assigned = store(_assigned(packed, key, centroids), "clusters")
    # One row a centroid.
    inertia = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    described = spark.createDataFrame(
        [
            (number, inertia.get(number, 0), sum(inertia.values()), _digest(centroid))
            for number, centroid in enumerate(centroids)
        ],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(described), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def _rounds_sql() -> str:
    """Assignment and move of every round as chained table expressions."""
    parts = []
    for number in range(ROUNDS + 1):
        parts.append(f"""
a{number} as (
    select key, v, cluster, away as distance from (
        select kept.key, kept.v, c.cluster,
            list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))
                ::bigint as away,
            row_number() over (partition by kept.key order by away, c.cluster) as place
        from kept, c{number} as c)
    where place = 1)""")
        if number < ROUNDS:
            parts.append(f"""
m{number} as (
    select cluster, list(mean order by pos) as v from (
        select cluster, pos, sum(x)::bigint as total, count(*) as n,
            (total - ((total % n) + n) % n) // n as mean
        from (select cluster, unnest(v) as x, unnest(range({DIMS})) as pos from a{number})
        group by cluster, pos)
    group by cluster),
c{number + 1} as (
    select c.cluster, coalesce(m.v, c.v) as v
    from c{number} as c left join m{number} as m using (cluster))""")
    return ",".join(parts)


SQL = f"""
with kept as (
    select row_number() over () as key, vec_id,
        list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
    from embeddings
    where len(embedding) = {DIMS}
        and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {DIMS}),
c0 as (
    select (row_number() over (order by token, v) - 1)::int as cluster, v
    from (select sha256('1:' || vec_id) as token, v from kept order by 1 nulls last, 2
        limit {CENTROIDS})),
{_rounds_sql()},
inertias as (
    select cluster, sum(distance)::bigint as cluster_inertia from a{ROUNDS} group by cluster)
select vec_id, cluster, distance, cluster_inertia,
    (select sum(distance)::bigint from a{ROUNDS}) as inertia,
    sha256(array_to_string(c.v, ',')) as centroid_sha256
from a{ROUNDS} join kept using (key) join inertias using (cluster) join c{ROUNDS} as c using (cluster)
"""
