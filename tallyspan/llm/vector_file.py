"""Exact top-k inner products with a vector-approximation file.

1. Components are integers. Every dimension's range is cut into at most 256 cells of one width, and each
   vector is stored as one byte per dimension, packed in blocks.
2. The queries, in blocks, meet every block of cells. For one query the exact score lies between the score of
   the cell's lower corners and a slack that depends on the query only, so one matrix product bounds a block.
   What cannot be among the k best of its own block is dropped there.
3. Exact vectors are read in the order of their bounds: first each query's k best by bound, which gives a k-th
   exact score, then those whose bound reaches that score. Nothing else can be a result.

Equal vectors have equal scores and ties go to the smaller id, so of each distinct vector the k + 1 least ids
are kept (one may be the query itself); no other row of it can be a result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyspan.session import materialise

CELLS = 256
BLOCK = 4096
QUERY_BLOCK = 256
_EXACT = float(1 << 53)


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v, key): floor(scale * x) of vectors without null or non-finite components; ids are not null.

    Rows that repeat an id with the same integers are one row.
    """
    x = F.col("embedding").cast("array<double>")
    fine = F.col("vec_id").isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    return (
        vectors.where(fine)
        .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
        .withColumn("key", F.xxhash64(F.size("v"), "v"))
        .dropDuplicates(["vec_id", "key"])
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _ranges(batches):
    """(dims, d, lo, hi): least and largest component of a task's vectors."""
    seen: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        sizes = np.array(batch.column(0).value_lengths())
        for dims in np.unique(sizes):
            m = _matrix(batch.column(0).filter(pa.array(sizes == dims)))
            lo, hi = m.min(axis=0), m.max(axis=0)
            old = seen.get(int(dims))
            seen[int(dims)] = [lo, hi] if old is None else [np.minimum(old[0], lo), np.maximum(old[1], hi)]
    for dims, (lo, hi) in seen.items():
        yield pa.RecordBatch.from_pydict(
            {"dims": pa.array([dims] * dims, pa.int64()), "d": pa.array(np.arange(dims)), "lo": pa.array(lo), "hi": pa.array(hi)}
        )


def _packed(size: int, pack):
    """Blocks of at most ``size`` vectors of one dimension: (dims, number, ids, keys, data)."""

    def run(batches):
        held: dict[int, list] = {}

        def out(dims, rows):
            ids, keys, m = (np.concatenate(x) for x in zip(*rows))
            for a in range(0, len(ids), size):
                yield pa.RecordBatch.from_pydict(
                    {
                        "dims": pa.array([dims], pa.int64()),
                        "ids": [ids[a : a + size].tobytes()],
                        "keys": [keys[a : a + size].tobytes()],
                        "data": [pack(dims, m[a : a + size]).tobytes()],
                    }
                )

        for batch in batches:
            sizes = np.array(batch.column(2).value_lengths())
            for dims in np.unique(sizes):
                own = batch.filter(pa.array(sizes == dims))
                rows = held.setdefault(int(dims), [])
                rows.append((own.column(0).to_numpy(), own.column(1).to_numpy(), _matrix(own.column(2))))
                if sum(len(r[0]) for r in rows) >= size:
                    yield from out(int(dims), held.pop(int(dims)))
        for dims, rows in held.items():
            yield from out(dims, rows)

    return run


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two integer matrices, as floats where they are exact, else as integers."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < _EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return a.astype(object) @ b.astype(object).T


def _bounds(grid: dict, k: int):
    """(query_id, query_key, vec_id, key, floor, slack): what may be among the k best of its block."""

    def run(batches):
        for batch in batches:
            for dims, ids, keys, cells, q_ids, q_keys, q_data in zip(*(c.to_pylist() for c in batch.columns)):
                lo, width = grid[dims]
                ids, keys, q_ids, q_keys = (np.frombuffer(x, np.int64) for x in (ids, keys, q_ids, q_keys))
                corner = lo + np.frombuffer(cells, np.uint8).reshape(-1, dims).astype(np.int64) * width
                queries = np.frombuffer(q_data, np.int64).reshape(-1, dims)
                scores = product(queries, corner)
                up = product(np.maximum(queries, 0), (width - 1)[None, :])[:, 0]
                down = product(np.minimum(queries, 0), (width - 1)[None, :])[:, 0]
                own = q_ids[:, None] == ids[None, :]
                for i in range(len(q_ids)):
                    row = scores[i][~own[i]]
                    if len(row) == 0:
                        continue
                    least = np.partition(row, len(row) - k)[len(row) - k] + down[i] - up[i] if len(row) > k and row.dtype != object else (sorted(row)[-min(k, len(row))] + down[i] - up[i])
                    good = np.flatnonzero((scores[i] >= least) & ~own[i])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "query_id": pa.array(np.full(len(good), q_ids[i])),
                            "query_key": pa.array(np.full(len(good), q_keys[i])),
                            "vec_id": pa.array(ids[good]),
                            "key": pa.array(keys[good]),
                            "at_least": pa.array([int(s + down[i]) for s in scores[i][good]], pa.decimal128(38, 0)),
                            "at_most": pa.array([int(s + up[i]) for s in scores[i][good]], pa.decimal128(38, 0)),
                        }
                    )

    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query row against all other rows.

    ``is_query`` makes a condition from the id column. Vectors of different length are not compared. Fewer than
    k other rows give fewer results; no rows, no result. Null ids take no part, nor do null or non-finite
    components. Rows with the query's own id are not its candidates. Other columns are ignored.
    """
    spark = vectors.sparkSession
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = materialise(integers(vectors, scale), "vectors")
    queries = rows.where(is_query(F.col("vec_id")))
    first = Window.partitionBy("key", "v").orderBy("vec_id")
    stored = materialise(rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).drop("n"), "distinct-vectors")
    grid = {}
    for r in (
        stored.select("v").mapInArrow(_ranges, "dims long, d long, lo long, hi long")
        .groupBy("dims", "d").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("dims", "d").collect()
    ):
        grid.setdefault(r["dims"], []).append((r["lo"], max(1, -(-(r["hi"] - r["lo"] + 1) // CELLS))))
    grid = {dims: tuple(np.array(x, np.int64) for x in zip(*cells)) for dims, cells in grid.items()}

    def cells(dims, m):
        lo, width = grid[dims]
        return ((m - lo) // width).astype(np.uint8)

    schema = "dims long, ids binary, keys binary, data binary"
    approximations = materialise(
        stored.select("vec_id", "key", "v").mapInArrow(_packed(BLOCK, cells), schema).withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parallel))), "cells"
    )
    blocks = queries.select("vec_id", "key", "v").mapInArrow(_packed(QUERY_BLOCK, lambda _, m: m), schema)
    # every query block goes to every part of the file: a stated query set against all rows, in blocks
    sent = blocks.select(
        "dims", F.col("ids").alias("q_ids"), F.col("keys").alias("q_keys"), F.col("data").alias("q_data"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parallel - 1).cast("long"))).alias("part"),
    )
    bounded = (
        approximations.join(sent, ["dims", "part"])
        .select("dims", "ids", "keys", "data", "q_ids", "q_keys", "q_data")
        .mapInArrow(_bounds(grid, k), "query_id long, query_key long, vec_id long, key long, at_least decimal(38,0), at_most decimal(38,0)")
    )
    bounded = materialise(bounded, "bounds")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("at_most"), "vec_id", "key")
    turn = bounded.withColumn("turn", F.row_number().over(order))

    def exact(pairs: DataFrame) -> DataFrame:
        """Read the exact vectors of ``pairs``."""
        mine = queries.select(F.col("vec_id").alias("query_id"), F.col("key").alias("query_key"), F.col("v").alias("q"))
        score = F.aggregate(F.zip_with("v", "q", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
        return (
            pairs.select("query_id", "query_key", "vec_id", "key")
            .join(stored, ["vec_id", "key"])
            .join(mine, ["query_id", "query_key"])
            .select("query_id", "query_key", "vec_id", "key", score.alias("score"))
        )

    begun = materialise(exact(turn.where(F.col("turn") <= k)), "first-read")
    certain = begun.groupBy("query_id", "query_key").agg(F.min("score").alias("kth"))
    rest = exact(turn.where(F.col("turn") > k).join(certain, ["query_id", "query_key"]).where(F.col("at_most") >= F.col("kth")))
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id", "key")
    return (
        begun.union(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
