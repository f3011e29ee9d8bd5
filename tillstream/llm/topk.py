"""Exact top-k by inner product, pruned by norms and rotated partial sums.

Vectors become integers, so scores are exact. All rows go into the second-moment matrix, whose
eigenvectors (the right singular vectors of the data) rotate the space so that the first few
coordinates carry most of the products. Candidates are dealt into chunks, queries into blocks;
each pair of a chunk and a block is one bounded group. Inside, candidates come by descending length:
 * once |query| * |candidate| is below the k-th best score so far, all later ones are out;
 * the product over the head coordinates plus the product of the residual lengths (Cauchy-Schwarz)
   bounds the score; only what could still reach the k-th best is computed in full, in integers.
The chunks' best k per query are merged by a ranking that Spark limits before its shuffle.

Vectors that are null or hold a null or non-finite component take no part. Shorter vectors, empty ones
among them, count as padded with zeros. Ties go to the smaller vec_id, null last. A query does not
find its own row; rows that repeat an id, or have none, are rows like any other, and a repeated id
asks as often as it comes. An empty table gives no rows. Extra columns are not read. Components of 2**24 or more after quantising need `wide` rows, which the query takes
by itself. Refused with an error is what the 64 bits of a score or component cannot hold, as in SQL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstream.llm.common import table, written

K, SCALE, HEAD = 5, 256, 24
# Products of lengths from here on are summed in Python's integers, which do not wrap. Scores below
# 64 bits stand as LOWEST until it is known whether they are among the best.
WRAPS, LOWEST = 2.0 ** 62, np.iinfo(np.int64).min + 2
QUERY_BLOCK, LEAST_CHUNK, MOST_CHUNK, STRIP = 2048, 1024, 1 << 18, 1024


def _beyond(vector: Column, limit: float) -> Column:
    return F.exists(vector, lambda c: F.abs(c) >= limit)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
              scale: int = SCALE, wide: bool = False) -> DataFrame:
    """(row, vec_id, v) with integer components floor(scale * x) of all vectors that take part.

    `row` tells rows apart; write the result before using it more than once.

    Components are 32-bit integers below 2**24, or with `wide` 64-bit ones below 2**62.
    """
    x = F.col(vector_col)
    limit = 2.0 ** (62 if wide else 24) / scale
    sound = x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = F.when(_beyond(x, limit), F.raise_error(F.lit(
        f"a component is {limit} or more"))).otherwise(x)
    return vectors.filter(sound).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.transform(
            held, lambda c: F.floor(c.cast("double") * scale).cast("long" if wide else "int")
        ).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy().astype(np.int64)
    if (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Columns: eigenvectors of the second-moment matrix over all rows, strongest first."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            part = _matrix(batch.column(0), width).astype(float)
            total += part.T @ part
        place = np.arange(width * width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int32()), pa.array(total.ravel())], names=["place", "moment"])

    summed = rows.select("v").mapInArrow(moments, "place int, moment double").groupBy(
        "place").agg(F.sum("moment").alias("moment")).collect()
    matrix = np.zeros(width * width)
    for row in summed:  # width * width numbers, whatever the number of vectors
        matrix[row["place"]] = row["moment"]
    return np.linalg.eigh(matrix.reshape(width, width))[1][:, ::-1].copy()


def _products(found: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Scores that might not fit 64 bits; too high ones are an error, too low ones `LOWEST`."""
    scores = (found.astype(object) @ query.astype(object)).tolist()
    if max(scores) > np.iinfo(np.int64).max:
        raise OverflowError("one of the best scores does not fit 64 bits")
    return np.array([max(score, LOWEST) for score in scores], np.int64)


def best_in_chunk(queries: np.ndarray, query_ids: np.ndarray, found: np.ndarray,
                  found_ids: np.ndarray, axes: np.ndarray, k: int = K, head: int = HEAD,
                  strip: int = STRIP, ties: np.ndarray | None = None,
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, found id, score) of each query's best k in a chunk, and how many were scored.

    A query does not find its own id. Ties go to the least of `ties`, or else of the ids.
    """
    ties = found_ids if ties is None else ties
    turned_q, turned = queries @ axes, found @ axes
    norms, q_norms = np.linalg.norm(turned, axis=1), np.linalg.norm(turned_q, axis=1)
    order = np.lexsort((ties, -norms))
    found, found_ids, turned, norms = found[order], found_ids[order], turned[order], norms[order]
    ties = ties[order]
    rest, q_rest = (np.linalg.norm(m[:, head:], axis=1) for m in (turned, turned_q))
    none = np.iinfo(np.int64).min + 1
    best = np.full((len(queries), k), none)
    best_ids, best_ties = (np.full((len(queries), k), np.iinfo(np.int64).max) for _ in range(2))
    scored = 0
    for a in range(0, len(found), strip):
        b = min(a + strip, len(found))
        # Floating bounds get a margin far above their rounding errors.
        slack = 1e-9 * q_norms * norms[a] + 1e-3
        floor = best[:, -1]
        open_q = np.flatnonzero((floor == none) | (q_norms * norms[a] + slack >= floor))
        if not len(open_q):
            break
        bound = turned_q[open_q, :head] @ turned[a:b, :head].T
        bound += q_rest[open_q, None] * rest[None, a:b] + slack[open_q, None]
        maybe = bound >= floor[open_q, None]
        maybe &= query_ids[open_q, None] != found_ids[None, a:b]
        for row, at in zip(open_q.tolist(), maybe, strict=True):
            columns = np.flatnonzero(at)
            if not len(columns):
                continue
            scored += len(columns)
            # Sums below 2**63 are exact even if they wrap on the way.
            exact = np.matmul if q_norms[row] * norms[a] < WRAPS else _products
            scores = np.concatenate([best[row], exact(found[a + columns], queries[row])])
            ids = np.concatenate([best_ids[row], found_ids[a + columns]])
            tied = np.concatenate([best_ties[row], ties[a + columns]])
            # Places that are still empty come after all found ones, whatever their tie.
            top = np.lexsort((tied, -scores))[:k]
            best[row], best_ids[row], best_ties[row] = scores[top], ids[top], tied[top]
    rows, places = np.nonzero(best != none)
    return rows, best_ids[rows, places], best[rows, places], scored


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, head: int = HEAD) -> DataFrame:
    """query_id, rank, vec_id, score; both sides are `quantised` rows, `vectors` stored ones."""
    count, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(width or 0, 1)
    if not count:
        return vectors.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score long")
    axes = rotation(vectors, width)
    chunk = min(max(8 * math.isqrt(count), LEAST_CHUNK), MOST_CHUNK)
    chunks, blocks = math.ceil(count / chunk), math.ceil(queries.count() / QUERY_BLOCK) or 1

    def dealt(rows: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return rows.select(
            "row", "vec_id", "v", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))

    left = dealt(queries, "block", blocks, "chunk", chunks)
    right = dealt(vectors, "chunk", chunks, "block", blocks)

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        parts = [t.combine_chunks() for t in (asked, held)]
        at = [t.column("row").to_numpy() for t in parts]
        if not len(at[0]) or not len(at[1]):
            return FOUND.empty_table()
        m = [_matrix(t.column("v").combine_chunks(), width) for t in parts]
        ids = parts[1].column("vec_id")
        ties = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        asking, found, score, _ = best_in_chunk(
            m[0], at[0], m[1], at[1], axes, k, head, ties=ties)
        order = np.argsort(at[1])
        place = order[np.searchsorted(at[1], found, sorter=order)]
        return pa.table([at[0][asking], parts[0].column("vec_id").take(pa.array(asking)),
                         ids.take(pa.array(place)), score], schema=FOUND)

    near = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInArrow(
        search, "row long, query_id long, vec_id long, score long")
    ranked = near.withColumn("rank", F.row_number().over(
        Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())))
    score = F.when(F.col("score") == int(LOWEST), F.raise_error(F.lit(
        "one of the best scores does not fit 64 bits"))).otherwise(F.col("score"))
    return ranked.filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", score.alias("score"))


FOUND = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    # Twice the bytes only where a component needs them.
    wide = not embeddings.filter(_beyond(F.col("embedding"), 2.0 ** 24 / SCALE)).isEmpty()
    vectors = written(quantised(embeddings, wide=wide), "vectors")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


OP9_SQL = """
WITH sizes AS (SELECT greatest(max(len(embedding)), 1) AS width FROM embeddings),
vectors AS (
  SELECT row_number() OVER () AS row, vec_id, list_resize(list_transform(
           embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)), width, 0) AS v
  FROM embeddings, sizes
  WHERE embedding IS NOT NULL AND len(list_filter(
    embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.row <> c.row WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) AS rank
  FROM scored) WHERE rank <= 5
"""
