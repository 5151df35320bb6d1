"""Joins over whole tables: no row is left out, and no list of nodes is too long."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.operators import joins
from driftline.plans.catalog import QUERIES


def brute(points, nodes):
    best = []
    for x, y in points:
        d2 = (nodes[:, 1] - x) * (nodes[:, 1] - x) + (nodes[:, 2] - y) * (nodes[:, 2] - y)
        best.append((int(nodes[d2 == d2.min(), 0].min()), d2.min()))
    return best


@pytest.mark.parametrize("n", [1, 5, 3000])
def test_nearest_node(spark, n):
    rng = np.random.default_rng(n)
    places = np.r_[rng.normal(0, 30, (n - n // 3, 2)), rng.integers(-5, 5, (n // 3, 2)) * 40.0]  # a clump, and repeats that tie
    nodes = np.c_[rng.permutation(n), places]
    points = [*map(tuple, rng.uniform(-2000, 2000, (150, 2)).tolist()), *map(tuple, rng.normal(0, 50, (150, 2)).tolist()), (0.0, 20.0), (0.0, 20.0), (1e6, -1e6)]
    n_df = spark.createDataFrame([(int(i), float(x), float(y)) for i, x, y in nodes] + [(-1, None, 0.0), (-2, float("nan"), 0.0)], "node long, x double, y double")
    p_df = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(points)] + [(-1, None, 1.0)], "seq long, x double, y double")
    got = {r["seq"]: (r["node"], r["d2"]) for r in joins.nearest_node(p_df, n_df).collect()}
    assert got.pop(-1) == (None, None)
    assert [got[k] for k in range(len(points))] == brute(points, nodes)
    assert joins.nearest_node(p_df, n_df.where("false")).where("node is null").count() == len(points) + 1


def test_nearest_node_takes_more_than_100_000_nodes(spark):
    nodes = spark.range(120_000).select(F.col("id").alias("node"), (F.col("id") % 400 * 1.0).alias("x"), (F.floor(F.col("id") / 400) * 1.0).alias("y"))
    points = spark.range(500).select(F.col("id").alias("seq"), (F.col("id") % 400 + 0.25).alias("x"), (F.col("id") % 300 + 0.25).alias("y"))
    assert joins.nearest_node(points, nodes).where("node = seq % 400 + 400 * (seq % 300) and d2 = 0.125").count() == 500


def test_no_row_is_left_out(spark, sf_dir):
    orders, events = (spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("orders", "events"))
    for name in ("j2_nearest_of_all_orders", "j3_neighbours_of_all_orders", "j4_points_of_all_orders"):
        assert QUERIES[name](spark, sf_dir).count() == orders
    assert QUERIES["j8_nearest_node_of_all"](spark, sf_dir).where("node is not null").count() == events
