"""Reference systems: recorded, kept through files, and never mixed."""

import math

import pytest
from pyspark.sql import functions as F

from incidex.functions.crs import SIRGAS_2000, WEB_MERCATOR, WGS_84, SridMismatch, srid_of, to_srid, with_srid
from incidex.functions.geometry import EARTH_RADIUS_M
from incidex.operators.spatial import dissolve, spatial_join, zone_edges
from incidex.session import shared_path

SQUARE = [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]]
EDGE = ("x1", "y1", "x2", "y2")


def zones(spark):
    return spark.createDataFrame([(1, SQUARE)], "id int, rings array<array<struct<x double, y double>>>")


def points(spark):
    return spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 2.0), (3, None, 0.5)], "p int, x double, y double")


def test_recorded_through_files_edges_and_dissolve(spark):
    path = shared_path(spark, "zones")
    df = zones(spark).withMetadata("rings", {"comment": "parts"})
    with_srid(df, WGS_84, "rings").write.parquet(path)
    read = spark.read.parquet(path)
    assert srid_of(read, "rings") == WGS_84 and read.schema["rings"].metadata["comment"] == "parts"
    edges = zone_edges(read, ["id"])
    assert srid_of(edges, *EDGE) == WGS_84
    assert srid_of(dissolve(edges, ["id"]), *EDGE) == WGS_84
    assert srid_of(zone_edges(zones(spark), ["id"]), *EDGE) is None


def test_joins_refuse_two_systems(spark):
    edges = zone_edges(with_srid(zones(spark), WGS_84, "rings"), ["id"])
    old = with_srid(points(spark), SIRGAS_2000, "x", "y")
    with pytest.raises(SridMismatch, match="4674.*4326"):
        spatial_join(old, edges, ["id"], cell=1.0)
    for pts in (to_srid(old, WGS_84, x="x", y="y"), points(spark)):
        assert [r["p"] for r in spatial_join(pts, edges, ["id"], cell=1.0).collect()] == [1]


def test_reprojection(spark):
    old = with_srid(points(spark), SIRGAS_2000, "x", "y")
    new = to_srid(old, WEB_MERCATOR, x="x", y="y")
    assert srid_of(new, "x", "y") == WEB_MERCATOR
    got = {r["p"]: r for r in new.collect()}
    assert math.isclose(got[1]["x"], EARTH_RADIUS_M * math.radians(0.5))
    assert math.isclose(got[1]["y"], EARTH_RADIUS_M * math.asinh(math.tan(math.radians(0.5))))
    assert got[3]["x"] is None
    rings = to_srid(with_srid(zones(spark), WGS_84, "rings"), WEB_MERCATOR, rings="rings")
    assert srid_of(rings, "rings") == WEB_MERCATOR
    assert math.isclose(rings.first()["rings"][0][1]["x"], EARTH_RADIUS_M * math.radians(1.0))
    assert to_srid(old, SIRGAS_2000, x="x", y="y") is old


def test_refused(spark):
    mercator = with_srid(points(spark), WEB_MERCATOR, "x", "y")
    with pytest.raises(SridMismatch, match="no way"):
        to_srid(mercator, WGS_84, x="x", y="y")
    with pytest.raises(SridMismatch, match="no SRID"):
        to_srid(points(spark), WGS_84, x="x", y="y")
    with pytest.raises(SridMismatch, match="to_srid"):
        with_srid(mercator, WGS_84, "x", "y")
    with pytest.raises(SridMismatch, match="one geometry"):
        srid_of(with_srid(with_srid(points(spark), WGS_84, "x"), SIRGAS_2000, "y"), "x", "y")
    assert srid_of(mercator.select((F.col("x") + 1).alias("x")), "x") is None
