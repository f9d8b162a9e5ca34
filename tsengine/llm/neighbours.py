"""Operator 7: nearest neighbours by inner product over randomly rotated one-bit codes, with exact reranking."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsengine.llm.chunks import parts_of
from tsengine.session import materialize

#: Width of the error bound in standard deviations of the estimate.
BOUND = 4.0
#: Best estimates per query, as a multiple of the neighbours asked for, whose exact products set the bar for all others.
FIRST = 4
SEED = 5
#: Pairs of vectors in one cell of the search at most, and vectors and queries in a cell at least (where there are as many).
_CELL_PAIRS = 1 << 28
_LEAST_ROWS, _LEAST_QUERIES = 2048, 256
#: Queries that share one table of byte sums.
_QUERY_STEP = 64

INDEX = "vec_id bigint, block int, vector binary, code binary, length double, cosine double"
_FOUND = "query_id bigint, vec_id bigint, score double"


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, vector)`` of the vectors that take part: not null, not empty, all components finite and not all zero."""
    v = F.col("vector")
    picked = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return picked.where(F.col("vec_id").isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def codes(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs of the rotated residuals, their lengths, and the cosine of each residual with its code."""
    rest = (vectors - centre) @ turn.T
    length = np.linalg.norm(rest, axis=1)
    cosine = np.abs(rest).sum(axis=1) / np.where(length > 0, length, 1) / math.sqrt(rest.shape[1])
    return np.packbits(rest > 0, axis=1), length, np.where(length > 0, cosine, 1.0)


def _indexer(centre: np.ndarray, turn: np.ndarray, blocks: int):
    def build(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column(1), len(centre))
            code, length, cosine = codes(vectors, centre, turn)
            yield pa.record_batch(
                {
                    "vec_id": batch.column(0),
                    "block": pa.array(batch.column(2).to_numpy() % blocks, pa.int32()),
                    "vector": pa.array([v.tobytes() for v in vectors], pa.binary()),
                    "code": pa.array([c.tobytes() for c in code], pa.binary()),
                    "length": pa.array(length),
                    "cosine": pa.array(cosine),
                }
            )

    return build


def estimates(code: np.ndarray, length: np.ndarray, cosine: np.ndarray, queries: np.ndarray, centre: np.ndarray, turn: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (rows: vectors, columns: queries) and their error bounds, from packed bits and two scalars.

    The signs of eight dimensions are one byte; a query's sums for all values of a byte are worked out once.
    """
    dims = queries.shape[1]
    turned = np.zeros((len(queries), code.shape[1] * 8))
    turned[:, :dims] = queries @ turn.T
    signs = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1
    sums = np.einsum("ts,qbs->btq", signs, turned.reshape(len(queries), -1, 8)).astype(np.float32)
    dot = sums[0][code[:, 0]]
    for b in range(1, code.shape[1]):
        dot += sums[b][code[:, b]]
    scale = length / np.maximum(cosine, 1e-12)
    about = dot * (scale / math.sqrt(dims)).astype(np.float32)[:, None] + (queries @ centre).astype(np.float32)
    error = bound * scale * np.sqrt(np.maximum(1 - cosine**2, 0)) / math.sqrt(max(dims - 1, 1))
    return about, error.astype(np.float32)[:, None] * np.linalg.norm(queries, axis=1).astype(np.float32)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _searcher(centre: np.ndarray, turn: np.ndarray, k: int, bound: float):
    dims = len(centre)

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if rows.num_rows and queries.num_rows:
            ids = rows["vec_id"].to_numpy()
            vectors = np.frombuffer(b"".join(rows["vector"].to_pylist()), float).reshape(-1, dims)
            code = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
            length, cosine = rows["length"].to_numpy(), rows["cosine"].to_numpy()
            own = queries["vec_id"].to_numpy()
            asked = np.frombuffer(b"".join(queries["vector"].to_pylist()), float).reshape(-1, dims)
            for begin in range(0, len(own), _QUERY_STEP):
                step = slice(begin, begin + _QUERY_STEP)
                about, error = estimates(code, length, cosine, asked[step], centre, turn, bound)
                for q, vector, near, wide in zip(own[step], asked[step], about.T, error.T, strict=True):
                    other = ids != q
                    near = np.where(other, near, -np.inf)
                    first = np.argpartition(-near, min(FIRST * k, len(near)) - 1)[: FIRST * k]
                    first = first[other[first]]
                    bar = np.sort(np.einsum("ij,j->i", vectors[first], vector))[-k] if len(first) >= k else -np.inf
                    chosen = np.flatnonzero((near + wide >= bar - 1e-6) & other)
                    chosen = np.union1d(chosen, first)
                    scores = np.einsum("ij,j->i", vectors[chosen], vector)
                    top = _best(ids[chosen], scores, k)
                    out[0].append(np.full(len(top), q))
                    out[1].append(ids[chosen][top])
                    out[2].append(scores[top])
        joined = [np.concatenate(c) if c else np.empty(0) for c in out]
        return pa.table({"query_id": pa.array(joined[0].astype(np.int64)), "vec_id": pa.array(joined[1].astype(np.int64)), "score": pa.array(joined[2].astype(float))})

    return search


def _layout(rows: int, queries: int, parts: int) -> tuple[int, int]:
    """Blocks of vectors and of queries: as many cells as tasks or bounded cells ask for, in the shape that copies fewest rows."""
    cells = max(parts, math.ceil(rows * queries / _CELL_PAIRS))
    blocks = max(1, round(math.sqrt(cells * rows / max(queries, 1))))
    blocks = max(min(blocks, math.ceil(rows / _LEAST_ROWS)), 1)
    return blocks, max(1, min(math.ceil(cells / blocks), math.ceil(queries / _LEAST_QUERIES)))


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", bound: float = BOUND) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query the ``k`` rows with the largest inner product, ties to the smaller id.

    Every vector is indexed: the signs of its randomly rotated residual from the mean, the residual's length and its cosine with the
    code. A query estimates all products from the codes; the exact products of its best estimates give a bar, and every vector
    whose estimate plus error bound reaches the bar is compared exactly, in double precision. Blocks of queries meet blocks of vectors.
    Vectors meet those of their own length; each length has a mean and a rotation of its own.

    ``is_query`` is a condition on ``vec_id``. Rows with the query's own id are not its neighbours; with fewer candidates than ``k``
    all are returned. Null ids, and vectors that are null, empty, zero or hold null or non-finite components, take no part.
    Of query rows of one length that share an id the smallest vector asks. Other columns are not read.
    """
    spark = vectors.sparkSession
    picked = materialize(usable(vectors, id_col, vector_col).withColumn("hash", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 31))), "vectors")
    lengths = picked.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy("dims").collect()
    found = [_found_in(picked.where(F.size("vector") == r["dims"]), r["dims"], r["n"], is_query, k, bound) for r in lengths]
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = functools.reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _found_in(picked: DataFrame, dims: int, rows: int, is_query, k: int, bound: float) -> DataFrame:
    """The ``k`` best of each cell that a query's block meets, among vectors of one length."""
    spark = picked.sparkSession
    sums = picked.select(*[F.avg(F.col("vector")[i]).alias(f"c{i}") for i in range(dims)], F.lit(0).alias("z")).first()
    centre, turn = np.array(sums[:dims]), rotation(dims)
    asked = picked.where(is_query)
    blocks, query_blocks = _layout(rows, asked.count(), parts_of(spark))
    index = materialize(picked.select("vec_id", "vector", "hash").mapInArrow(_indexer(centre, turn, blocks), INDEX), "vector-index")
    queries = index.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    queries = queries.select("vec_id", "vector", F.pmod(F.xxhash64(F.lit(SEED), "vec_id"), F.lit(query_blocks)).cast("int").alias("query_block"))
    dealt_rows = index.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    dealt_queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cells = ["block", "query_block"]
    return dealt_rows.groupBy(*cells).cogroup(dealt_queries.groupBy(*cells)).applyInArrow(_searcher(centre, turn, k, bound), _FOUND)
