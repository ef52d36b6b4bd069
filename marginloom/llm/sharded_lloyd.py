"""Centroid clustering: Lloyd's rounds over column blocks, in exact integer arithmetic.

Vectors are cut into tiles: some rows of one block of columns. A task holds tiles of one block and needs that
block's slice of the centroids only. In a round it computes the exact partial distances of its tiles;
``reduceByKey`` adds the blocks of the same rows and takes the nearest centroid; the numbers of the centroids go
back to the tiles, and each block sums its own columns to its own new slice.

Tiles are written once and dealt to tasks once: every round reads the same shuffled files, and only partial
distances (one number per vector, centroid and block) and assignments (one byte to four per vector and block)
move. What reaches the driver is one slice per block, k x dims numbers, whatever the number of vectors is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from .scratch import Scratch

K = 8
ROUNDS = 10
SCALE = 1024
SEED = "3"
#: Columns of a block and vectors of a tile.
WIDTH = 32
TILE_ROWS = 1024
#: k x dims, the numbers that the driver holds in a round.
MAX_CENTROID_NUMBERS = 50_000_000


def whole_vectors(vector: Column, dims: int) -> Column:
    """Whether there are ``dims`` components, none null or non-finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, finite), F.lit(False))


def scaled(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x); stops where squared distances might not fit into 64 bits."""
    numbers = np.floor(scale * vectors.astype(np.float64))
    most = int((2.0**61 / max(1, vectors.shape[-1])) ** 0.5)
    if numbers.size and np.abs(numbers).max() > min(most, 2**31 - 1):
        raise OverflowError(f"a component is too large: {scale} times it must be within {most}")
    return numbers.astype(np.int64)


def _tiles(kept: DataFrame, scale: int, width: int, rows: int) -> DataFrame:
    """chunk, block, ids (in block 0) and data (32-bit integers, row by row) for each tile of ``kept`` (id, vector)."""
    id_type = kept.schema["id"].dataType
    kind = pa.schema(
        [("chunk", pa.int64()), ("block", pa.int32()), ("ids", pa.list_(to_arrow_type(id_type))), ("data", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
                data = scaled(flat.reshape(part.num_rows, -1), scale).astype("<i4")
                out = []
                for block, left in enumerate(range(0, data.shape[1], width)):
                    ids = part.column(0).to_pylist() if block == 0 else None
                    out.append({"chunk": chunk, "block": block, "ids": ids, "data": data[:, left : left + width].tobytes()})
                yield pa.RecordBatch.from_pylist(out, kind)
                chunk += 1

    types = {"chunk": LongType(), "block": IntegerType(), "ids": ArrayType(id_type), "data": BinaryType()}
    return kept.mapInArrow(cut, StructType([StructField(*field) for field in types.items()]))


def partial_distances(tile: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances within one block of columns; a row per vector, a column per centroid."""
    out = np.empty((len(tile), len(centroids)), np.int64)
    wide = tile.astype(np.int64)
    for c, centroid in enumerate(centroids):
        apart = wide - centroid
        out[:, c] = np.einsum("ij,ij->i", apart, apart)
    return out


def nearest(distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and distance of the nearest centroid; the smaller number of equally near ones."""
    cluster = distances.argmin(axis=1).astype(np.int32)
    return cluster, np.take_along_axis(distances, cluster[:, None].astype(np.int64), 1)[:, 0]


class _Tiles:
    """Tiles dealt to tasks, each with one block of columns."""

    def __init__(self, spark: SparkSession, table: DataFrame, widths: list[int], chunks: int):
        self.widths, blocks = widths, len(widths)
        tasks = max(1, min(chunks, int(spark.conf.get("spark.sql.shuffle.partitions")) // blocks))
        self.tasks = tasks

        def task_of(key: tuple[int, int]) -> int:
            block, chunk = key
            return block * tasks + (chunk ^ (chunk >> 32)) % tasks

        self.task_of = task_of
        rows = table.select("block", "chunk", "data").rdd.map(lambda r: ((r[0], r[1]), bytes(r[2])))
        self.dealt = rows.partitionBy(blocks * tasks, task_of)

    def assigned(self, centroids: np.ndarray):
        """RDD of (chunk, (number, distance of the nearest centroid for each row))."""
        widths, slices = self.widths, self.slices(centroids)

        def distances(tile):
            (block, chunk), data = tile
            return chunk, partial_distances(np.frombuffer(data, "<i4").reshape(-1, widths[block]), slices[block])

        summed = self.dealt.map(distances).reduceByKey(add, self.tasks, lambda chunk: chunk ^ (chunk >> 32))
        return summed.mapValues(nearest)

    def slices(self, centroids: np.ndarray) -> list[np.ndarray]:
        return np.split(centroids, np.cumsum(self.widths)[:-1], axis=1)

    def updated(self, centroids: np.ndarray) -> np.ndarray:
        """The centroids after one round."""
        widths, k = self.widths, len(centroids)

        def back(assigned):
            chunk, (cluster, _) = assigned
            numbers = cluster.astype(np.min_scalar_type(k))
            return [((block, chunk), numbers) for block in range(len(widths))]

        def sums(rows: Iterable):
            """Of this task's tiles; their assignments come first, as the union has them first."""
            clusters, found = {}, {}
            for (block, chunk), value in rows:
                if isinstance(value, np.ndarray):
                    clusters[(block, chunk)] = value
                    continue
                own = clusters.pop((block, chunk))
                tile = np.frombuffer(value, "<i4").reshape(-1, widths[block]).astype(np.int64)
                total, count = found.setdefault(block, (np.zeros((k, widths[block]), np.int64), np.zeros(k, np.int64)))
                np.add.at(total, own, tile)
                count += np.bincount(own, minlength=k)
            return iter(found.items())

        numbers = self.assigned(centroids).flatMap(back).partitionBy(self.dealt.getNumPartitions(), self.task_of)
        blocks = numbers.union(self.dealt).mapPartitions(sums)
        summed = blocks.reduceByKey(lambda x, y: (x[0] + y[0], x[1] + y[1]), len(widths))
        # every block divides its own sums; an empty cluster keeps its centroid
        slices = self.slices(centroids)

        def mean(item):
            block, (total, count) = item
            return block, np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], slices[block])

        return np.concatenate([s for _, s in sorted(summed.map(mean).collect(), key=lambda x: x[0])], axis=1)


def first_centroids(kept: DataFrame, k: int, seed: str, scale: int, dims: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``seed:id``, in that order; equal ids by their components."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = kept.orderBy(drawn, "vector").limit(k).select("vector").collect()
    return scaled(np.array([r.vector for r in rows], np.float64).reshape(len(rows), dims), scale)


def lloyd(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    dims: int = 64,
    k: int = K,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = SEED,
    width: int = WIDTH,
    tile_rows: int = TILE_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """Assignments (id column, cluster, distance; a row per kept vector) and the final centroids (k x dims).

    Kept are vectors of exactly ``dims`` components, none null or non-finite; each component x counts as the
    integer floor(scale * x). Distances are squared Euclidean ones, the smaller number wins a tie, a centroid is
    the floor of the mean, and an empty cluster keeps its centroid. Repeated rows, ids that repeat and null ids are
    vectors of their own; with fewer than k vectors there are that many centroids, with none an empty result.
    Other columns, whatever their names, are ignored. A component beyond what 64-bit distances allow stops the job.
    """
    spark = vectors.sparkSession
    if k * dims > MAX_CENTROID_NUMBERS:
        raise ValueError(f"{k} centroids of {dims} numbers are more than the driver holds")
    scratch = Scratch(spark, "lloyd")
    named = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").alias("vector"))
    kept = named.where(whole_vectors(F.col("vector"), dims))
    centroids = first_centroids(kept, k, seed, scale, dims)
    table = scratch.table(_tiles(kept, scale, width, tile_rows), "tiles")
    chunks = table.where("block = 0").count()
    tiles = _Tiles(spark, table, [min(width, dims - left) for left in range(0, dims, width)], chunks)
    if len(centroids):
        for _ in range(rounds):
            centroids = tiles.updated(centroids)
        rows = tiles.assigned(centroids).map(lambda x: (x[0], x[1][0].tolist(), x[1][1].tolist()))
    else:
        rows = spark.sparkContext.parallelize([], 1)
    nearby = scratch.table(spark.createDataFrame(rows, "chunk long, cluster array<int>, distance array<long>"), "nearest")
    both = table.where("block = 0").select("chunk", "ids").join(nearby, "chunk")
    places = both.select(F.inline(F.arrays_zip("ids", "cluster", "distance")))
    return scratch.table(places.toDF(id_column, "cluster", "distance"), "assigned"), centroids
