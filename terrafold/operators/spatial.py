"""Points in polygons by grid cells, hash joins and ray crossings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crossings(edges: Column, x: Column, y: Column) -> Column:
    """How many edges a ray from (x, y) towards larger x crosses; an edge holds its lower
    end and not its upper one, so a vertex counts once."""

    def crossed(e: Column) -> Column:
        spans = (e["y1"] <= y) != (e["y2"] <= y)
        at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
        return F.when(spans, (x < at).cast("int")).otherwise(0)

    return F.aggregate(edges, F.lit(0), lambda n, e: n + crossed(e))


def polygon_edges(polygons: DataFrame, key: str, ring: str) -> DataFrame:
    """(key, x1, y1, x2, y2): sides of each ring, the closing one included. ``ring`` is an
    array of structs with x and y; a vertex without both is passed over, and a ring of
    fewer than three vertices has no inside."""
    good = F.filter(F.col(ring), lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    sides = F.transform(F.sequence(F.lit(0), F.size("_r") - 1), lambda i: F.struct(F.get("_r", i).alias("a"), F.get("_r", (i + 1) % F.size("_r")).alias("b")))
    rows = polygons.where(F.col(ring).isNotNull()).withColumn("_r", good).where(F.size("_r") > 2).select(key, F.explode(sides).alias("s"))
    return rows.select(key, F.col("s.a.x").alias("x1"), F.col("s.a.y").alias("y1"), F.col("s.b.x").alias("x2"), F.col("s.b.y").alias("y2"))


def covering_cells(polygons: DataFrame, key: str, ring: str, cell: float) -> DataFrame:
    """(key, cx, cy, whole, edges): the grid cells that a polygon meets.

    Sides are dealt over the bands of height ``cell`` that they cross; a band's cells run
    from its first side to its last. A cell that no side crosses lies inside or outside
    as a whole: its centre decides once, those outside drop out and those inside carry no
    sides. The others carry their band's sides that a ray from within them can cross.
    """
    sides = polygon_edges(polygons, key, ring)
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    banded = sides.withColumn("cy", F.explode(F.sequence(F.floor(low / cell), F.floor(high / cell))))
    # the part of the side within the band, a little widened for rounding
    slope = F.when(F.col("y1") != F.col("y2"), (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    at = lambda y: F.col("x1") + (y - F.col("y1")) * slope
    bottom, top = F.greatest(low, F.col("cy") * cell), F.least(high, (F.col("cy") + 1) * cell)
    slack = cell * 1e-9
    # a level side is crossed by no ray, but it ends the inside: it lies in its cells from end to end
    banded = banded.withColumn("from_x", F.coalesce(F.least(at(bottom), at(top)), F.least("x1", "x2")) - slack).withColumn("to_x", F.coalesce(F.greatest(at(bottom), at(top)), F.greatest("x1", "x2")) + slack)
    bands = banded.groupBy(key, "cy").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2", "from_x", "to_x")).alias("sides"), F.min("from_x").alias("a"), F.max("to_x").alias("b"))
    cells = bands.withColumn("cx", F.explode(F.sequence(F.floor(F.col("a") / cell), F.floor(F.col("b") / cell))))
    left, right = F.col("cx") * cell, (F.col("cx") + 1) * cell
    mixed = F.exists("sides", lambda s: (s["from_x"] <= right) & (s["to_x"] >= left))
    centre = crossings(F.col("sides"), left + cell / 2, (F.col("cy") + 0.5) * cell) % 2 == 1
    ahead = F.transform(F.filter("sides", lambda s: s["to_x"] >= left), lambda s: F.struct(s["x1"].alias("x1"), s["y1"].alias("y1"), s["x2"].alias("x2"), s["y2"].alias("y2")))
    out = cells.withColumn("mixed", mixed).where(F.col("mixed") | centre)
    return out.select(key, "cx", "cy", (~F.col("mixed")).alias("whole"), F.when(F.col("mixed"), ahead).otherwise(F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")).alias("edges"))


def contained(points: DataFrame, polygons: DataFrame, x: str, y: str, key: str, ring: str, cell: float = 0.05) -> DataFrame:
    """Points with the key of each polygon that holds them: one row a pair.

    Joined by hash on the grid cell; only points in cells that a side crosses are tested
    by ray. Points without coordinates, or outside all polygons, have no row; a point on a
    side belongs to the polygon on the side of smaller x. Choose ``cell`` so that a
    polygon meets few thousand cells."""
    placed = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("cx", F.floor(F.col(x) / cell)).withColumn("cy", F.floor(F.col(y) / cell))
    met = placed.join(covering_cells(polygons, key, ring, cell), ["cx", "cy"])
    inside = F.col("whole") | (crossings(F.col("edges"), F.col(x), F.col(y)) % 2 == 1)
    return met.where(inside).drop("cx", "cy", "whole", "edges")
