from __future__ import annotations

import math

import numpy as np
import pytest

from tests.llm import brute
from tillstream.llm import topk as op
from tillstream.llm.common import written


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 1) for i, v in rows],
                                 "vec_id long, embedding array<float>, score int, v int")


def found(frame, divisor=50, **options):
    rows = written(op.quantised(frame), "vectors")
    return sorted((tuple(r) for r in op.top_k(
        rows, rows.filter(f"vec_id % {divisor} = 0"), **options).collect()), key=str)


def whole(rows):
    return {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in rows}


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_against_brute_force(spark, spread):
    rng = np.random.default_rng(1)
    scale = np.exp(rng.normal(0, spread, 700))[:, None]
    turned = rng.normal(size=(700, 12)) * np.linspace(2, 0.1, 12) @ rng.normal(size=(12, 12))
    rows = [(i, v.tolist()) for i, v in enumerate((scale * turned).astype(np.float32))]
    exact = whole(rows)
    assert found(vectors(spark, rows)) == sorted(brute.top_k(exact, range(0, 700, 50)), key=str)


def test_pruning_leaves_work_out():
    rng = np.random.default_rng(2)
    data = np.floor(256 * rng.normal(size=(4000, 32)) * np.exp(-np.arange(32) / 4)
                    * np.exp(rng.normal(0, 1, (4000, 1)))).astype(np.int64)
    axes = np.linalg.eigh((data.T @ data).astype(float))[1][:, ::-1]
    ids = np.arange(4000)
    rows, near, scores, scored = op.best_in_chunk(data[:40], ids[:40], data, ids, axes, 5, 8, 256)
    exact = {i: v.tolist() for i, v in enumerate(data)}
    got = sorted(zip(rows.tolist(), near.tolist(), scores.tolist()))
    assert got == sorted((q, i, s) for q, _, i, s in brute.top_k(exact, range(40)))
    assert scored < 40 * 4000 / 4


def test_ties_go_to_smaller_ids(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [0.5, float(i % 2)]) for i in range(1, 30)]
    assert [r[2] for r in found(vectors(spark, rows))] == [1, 2, 3, 4, 5]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -1.0]), (50, None), (100, [nan, 1.0]), (150, []), (1, [inf, 0.0]),
            (2, [1.0, None]), (3, [-0.001, 2.0]), (None, [9.0, 9.0]), (4, [1.0])]
    # Row 150 holds no component that is null or not finite: it asks and is found, with zeros.
    assert found(vectors(spark, rows)) == [
        (0, 1, 4, 65536), (0, 2, 150, 0), (0, 3, None, 0), (0, 4, 3, -131328),
        (150, 1, 0, 0), (150, 2, 3, 0), (150, 3, 4, 0), (150, 4, None, 0)]


def test_against_sql_with_odd_rows(spark, tmp_path):
    import duckdb

    rng = np.random.default_rng(3)
    rows = [(i % 230, rng.normal(size=4).round(1).tolist()) for i in range(300)]
    rows += [(None, [0.5] * 4), (None, []), (50, []), (50, [1.0]), (7, None), (8, [None] * 4)]
    frame = vectors(spark, rows)
    frame.write.parquet(str(tmp_path / "embeddings"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings/*.parquet'")
    expected = connection.execute(op.OP9_SQL).fetchall()
    names = [d[0] for d in connection.description]
    order = [names.index(c) for c in ("query_id", "rank", "vec_id", "score")]
    assert found(frame) == sorted((tuple(r[i] for i in order) for r in expected), key=str)


def test_few_repeated_and_no_rows(spark):
    assert found(vectors(spark, [])) == []
    assert found(vectors(spark, [(0, [1.0])])) == []
    same = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0])]
    # Both rows with id 0 ask, and each finds the other.
    assert found(vectors(spark, same)) == sorted(2 * [
        (0, 1, 0, 327680), (0, 2, 1, 65536), (0, 3, 1, 65536)], key=str)


def test_components_beyond_exact_sums_are_refused(spark):
    with pytest.raises(Exception, match="or more"):
        found(vectors(spark, [(0, [1e9]), (1, [1.0])]))


def test_large_components_do_not_cost_the_query(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200, [7e4, -3.0, 0.5, 1.0]), (201, [-9e5, 1.0, 1.0, 2e6]), (202, [0.0, 0.0, 1e11, 0.0])]
    vectors(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(r) for r in op.op9_exact_topk(spark, str(tmp_path)).collect())
    assert got == brute.top_k(whole(rows), [0, 50, 100, 200])


def test_products_beyond_64_bits():
    found = np.array([[1 << 40, -(1 << 40)], [3, 4], [1 << 40, 1 << 40]], np.int64)
    query = np.array([1 << 40, 1 << 40], np.int64)
    assert op._products(found[:2], query).tolist() == [0, 7 << 40]
    assert op._products(-found[2:], query).tolist() == [op.LOWEST]
    with pytest.raises(OverflowError):
        op._products(found, query)
