"""Nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

Each table turns unit vectors by a pseudo-rotation (three rounds of random signs and a fast Hadamard
transform) and assigns them to the nearest signed axis. A query also probes its next nearest axes.
Buckets are cut into blocks by their counted sizes, and every block scores its queries exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import materialize

TABLES = 8
PROBES = 16
BLOCK_ROWS = 2048
SEED = 2024


def padded_size(dim: int) -> int:
    return 1 << max(0, (dim - 1).bit_length())


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, in log2(width) passes."""
    count, width = rows.shape
    step = 1
    while step < width:
        pairs = rows.reshape(count, -1, 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(count, width)
        step *= 2
    return rows / np.sqrt(width)


def axis_scores(vectors: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Turned vectors against all signed axes: columns 0..d-1 are the axes, d..2d-1 their opposites."""
    count, dim = vectors.shape
    width = padded_size(dim)
    signs = np.random.default_rng([seed, table, width]).choice([-1.0, 1.0], size=(3, width))
    turned = np.zeros((count, width))
    turned[:, :dim] = vectors
    for row in signs:
        turned = hadamard(turned * row)
    return np.concatenate([turned, -turned], axis=1)


def _hashed(tables: int, probes: int, seed: int):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, asked, lists = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
            dims = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(dims)])
            codes, probed = [None] * len(dims), [None] * len(dims)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                block = values[(starts[rows][:, None] + np.arange(dim)).ravel()].reshape(len(rows), dim)
                block = block / np.abs(block).max(axis=1, keepdims=True)
                own, near = [], []
                for table in range(tables):
                    scores = axis_scores(block, table, seed)
                    order = np.argsort(-scores, axis=1, kind="stable")
                    own.append(order[:, 0])
                    near.append(order[:, :probes])
                own, near = np.stack(own, axis=1), np.concatenate(near, axis=1)
                for at, row in enumerate(rows):
                    codes[row] = own[at].tolist()
                    probed[row] = near[at].tolist() if asked[row] else None
            yield pa.RecordBatch.from_arrays(
                [
                    ids, batch.column(1), pa.array(dims, pa.int32()),
                    pa.array([values[a:b].tobytes() for a, b in zip(starts, starts[1:])], pa.binary()),
                    pa.array(codes, pa.list_(pa.int32())), pa.array(probed, pa.list_(pa.int32())),
                ],
                names=["vec_id", "asked", "dim", "vector", "codes", "probes"],
            )

    return hashed


def _reranked(k: int):
    def reranked(members: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(members) and len(asks):
            dim = int(members["dim"].iloc[0])
            vectors = np.frombuffer(b"".join(members["vector"])).reshape(-1, dim)
            queries = np.frombuffer(b"".join(asks["vector"])).reshape(-1, dim)
            ids, names = members["vec_id"].to_numpy(), asks["query_id"].to_numpy()
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            one_id, place = np.unique(ids, return_inverse=True)
            for query, name in zip(queries, names):
                norm = np.sqrt((query * query).sum())
                rough = (vectors @ query) / (norms * norm)
                rough[ids == name] = -np.inf
                chosen = np.flatnonzero(rough > -np.inf)
                best = np.full(len(one_id), -np.inf)
                np.maximum.at(best, place, rough)
                if len(best) > k:
                    # all that may tie with the k-th different id within rounding
                    least = np.partition(best, len(best) - k)[len(best) - k]
                    chosen = np.flatnonzero((rough >= least - 1e-9) & (rough > -np.inf))
                exact = (vectors[chosen] * query).sum(axis=1) / (norms[chosen] * norm)
                order = np.lexsort((ids[chosen], -exact))
                kept: dict[int, float] = {}
                for at in order:
                    kept.setdefault(int(ids[chosen[at]]), float(exact[at]))
                    if len(kept) == k:
                        break
                out += [(int(name), other, score) for other, score in kept.items()]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    return reranked


def _search(hashed: DataFrame, asks: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Best ``k`` of each probed block: rows (query_id, vec_id, score), a pair once for each table that found it."""
    bucket = ["dim", "table", "code"]
    members = hashed.select("vec_id", "dim", "vector", F.posexplode("codes").alias("table", "code"))
    sizes = (
        members.groupBy(*bucket).agg(F.count("*").alias("rows"))
        .join(asks.groupBy(*bucket).agg(F.count("*").alias("asking")), bucket)
        .select(
            *bucket,
            F.ceil(F.col("rows") / block_rows).cast("int").alias("blocks"),
            F.ceil(F.col("asking") / block_rows).cast("int").alias("ask_blocks"),
        )
    )
    # one row per table and signed axis: its size is fixed by the dimension
    sizes = materialize(sizes, "polytope-buckets")

    def dealt(rows: DataFrame, identity: str, own: str, own_blocks: str, other: str, other_blocks: str) -> DataFrame:
        one = F.pmod(F.xxhash64(identity, "table"), F.col(own_blocks)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1)).alias(other)
        return rows.join(sizes, bucket).select(*rows.columns, one, every)

    left = dealt(members, "vec_id", "block", "blocks", "ask_block", "ask_blocks")
    right = dealt(asks, "query_id", "ask_block", "ask_blocks", "block", "blocks")
    right = right.toDF(*right.columns)  # both sides stem from one table: give this one columns of its own
    key = [*bucket, "block", "ask_block"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        _reranked(k), "query_id bigint, vec_id bigint, score double"
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = TABLES,
    probes: int = PROBES,
    block_rows: int = BLOCK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """For each query row its ``k`` nearest found by cosine: query_id, rank, vec_id, score.

    Scores are dot product over the product of norms, in double precision on the original vectors;
    ties go to the smaller id. Vectors that are NULL, empty, zero or hold NULL or a non-finite
    component take no part, neither do rows without an id. Vectors meet those of the same length
    only. A repeated id counts once, with its best score. A query that finds fewer than ``k`` probes
    every axis of one table, which is all vectors. No candidates are capped.
    """
    values = F.col(vector_col).cast("array<double>")
    usable = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), is_query.alias("asked"), values.alias("values")).filter(
        F.col("vec_id").isNotNull()
        & (F.size("values") > 0)
        & ~F.exists("values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("values", lambda x: x != 0)
    )
    hashed = materialize(
        usable.mapInArrow(
            _hashed(tables, probes, seed),
            "vec_id bigint, asked boolean, dim int, vector binary, codes array<int>, probes array<int>",
        ),
        "polytope",
    )
    query = hashed.filter("asked").select(F.col("vec_id").alias("query_id"), "dim", "vector", "probes")
    width = F.size("probes") / F.lit(tables)
    asks = query.select("query_id", "dim", "vector", width.cast("int").alias("width"), F.posexplode("probes").alias("slot", "code"))
    asks = asks.select("query_id", "dim", "vector", F.floor(F.col("slot") / F.col("width")).cast("int").alias("table"), "code")

    def best(found: DataFrame) -> DataFrame:
        once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    first = materialize(best(_search(hashed, asks, k, block_rows)), "polytope-found")
    full = first.groupBy("query_id").agg(F.count("*").alias("found")).filter(F.col("found") >= k)
    short = materialize(query.join(full, "query_id", "left_anti").drop("probes"), "polytope-short")
    if not short.isEmpty():
        turns = F.call_function("shiftleft", F.lit(2), F.length(F.bin(F.col("dim") - 1)))
        axes = F.explode(F.sequence(F.lit(0), F.when(F.col("dim") > 1, turns).otherwise(F.lit(2)) - 1))
        everywhere = short.select("query_id", "dim", "vector", F.lit(0).alias("table"), axes.alias("code"))
        more = best(_search(hashed.withColumn("codes", F.slice("codes", 1, 1)), everywhere, k, block_rows))
        first = first.join(more.select("query_id").distinct(), "query_id", "left_anti").unionByName(more)
    return first.select("query_id", "rank", "vec_id", "score")
