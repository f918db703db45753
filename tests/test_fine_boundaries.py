"""Cells with many edges are cut into smaller ones: no row holds a finely drawn boundary."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidex.operators.spatial import spatial_join, zone_cells, zone_edges
from tests.test_spatial import SHAPES, brute, zones_df


def gear(n, cx, cy, r):
    """A closed ring of ``n`` vertices with teeth, edges of very different length."""
    k = np.arange(n)
    a = 2 * math.pi * (k / n) ** 1.5
    rad = r * np.where(k % 4 < 2, 1.0, 0.9 + 0.05 * np.sin(k))
    x, y = cx + rad * np.cos(a), cy + rad * np.sin(a)
    return np.append(x, x[0]), np.append(y, y[0])


def inside(px, py, x, y):
    """Even-odd test of points against one ring."""
    odd = np.zeros(len(px), bool)
    for at in range(0, len(px), 50):
        qx, qy = px[at:at + 50, None], py[at:at + 50, None]
        crosses = (y[None, :-1] > qy) != (y[None, 1:] > qy)
        with np.errstate(divide="ignore", invalid="ignore"):
            hit = x[None, :-1] + (qy - y[None, :-1]) / (y[None, 1:] - y[None, :-1]) * (x[None, 1:] - x[None, :-1])
        odd[at:at + 50] = (crosses & (hit > qx)).sum(axis=1) % 2 == 1
    return odd


def test_a_zone_of_100000_edges_in_one_cell(spark):
    rings = {1: gear(100_000, 5.0, 5.0, 3.0), 2: gear(40, 2.0, 7.5, 1.5), 3: gear(3000, 7.0, 2.0, 2.5)}
    import pandas as pd
    edges = spark.createDataFrame(pd.concat([pd.DataFrame({"z": z, "x1": x[:-1], "y1": y[:-1], "x2": x[1:], "y2": y[1:]})
                                             for z, (x, y) in rings.items()])).repartition(4)
    cells = zone_cells(edges, ["z"], 16.0, most_edges=300)
    sizes = cells.select(F.max(F.size("_edges")).alias("m"), F.min("_lv").alias("lv"), F.count("*").alias("n")).first()
    assert sizes.m <= 300 and sizes.lv < -1 and sizes.n < 20_000
    rng = np.random.default_rng(5)
    px, py = rng.uniform(0, 10, 1500), rng.uniform(0, 10, 1500)
    # and points close to the boundary
    x, y = rings[1]
    at = rng.integers(0, 100_000, 1500)
    px, py = np.append(px, x[at] + rng.normal(0, 1e-3, 1500)), np.append(py, y[at] + rng.normal(0, 1e-3, 1500))
    pts = spark.createDataFrame(pd.DataFrame({"p": np.arange(3000), "x": px, "y": py}))
    want = {(int(p), z) for z, (x, y) in rings.items() for p in np.flatnonzero(inside(px, py, x, y))}
    for limit in (1 << 30, 0):
        got = [(r.p, r.z) for r in spatial_join(pts, edges, ["z"], cell=16.0, most_edges=300, broadcast_limit=limit).collect()]
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("cell,most", [(1.0, 2), (2.5, 3)])
def test_borders_and_corners_in_finer_cells(spark, cell, most):
    """Edges that share a vertex are never apart: the last level keeps them in one row."""
    points = [(i, (i % 17) / 8.0, (i // 17) / 8.0) for i in range(17 * 17)]
    pts = spark.createDataFrame(points, "pid int, x double, y double")
    edges = zone_edges(zones_df(spark, SHAPES), ["zone_id"])
    got = [(r.pid, r.zone_id) for r in spatial_join(pts, edges, ["zone_id"], cell=cell, most_edges=most).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(points, SHAPES)


def test_null_keys_and_no_edges(spark):
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 3.5, 0.5)], "pid int, x double, y double")
    edges = zone_edges(zones_df(spark, {1: SHAPES[1]}), ["zone_id"]).withColumn("zone_id", F.lit(None).cast("int"))
    assert [r.pid for r in spatial_join(pts, edges, ["zone_id"], cell=4.0, most_edges=1).collect()] == [1]
    none = spark.createDataFrame([], T.StructType([T.StructField("zone_id", T.IntegerType())] +
                                                 [T.StructField(c, T.DoubleType()) for c in ("x1", "y1", "x2", "y2")]))
    assert spatial_join(pts, none, ["zone_id"]).count() == 0
