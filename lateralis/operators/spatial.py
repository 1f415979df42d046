"""Well paths, area polygons and their intersection as Spark joins.

An area is a closed ring ``array<struct<x, y>>`` (x = longitude, y = latitude); a well path is one
segment held in four double columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateralis.functions.columns import col
from lateralis.operators.skew import HOT_ROWS
from lateralis.session import broadcast_if_small

PATH = ("x1", "y1", "x2", "y2")
CELL = 0.1
BROADCAST_POINTS = 500_000
AXIS_CELLS = 16  # cells that a box may span along an axis on its own grid level
LARGEST_COORDINATE = 1e9
BOX = ("bx1", "by1", "bx2", "by2")


def well_paths(
    df: DataFrame,
    key: str = "API14",
    columns: Sequence[str] = ("LongitudeSHWGS84", "LatitudeSHWGS84", "LongitudeBHWGS84", "LatitudeBHWGS84"),
) -> DataFrame:
    """One segment from surface to bottom hole per key.

    Should a key have several positions, the smallest is taken, so that the result is repeatable.
    """
    position = F.struct(*[col(c).alias(p) for c, p in zip(columns, PATH)])
    return df.groupBy(col(key)).agg(F.min(position).alias("_path")).select(col(key), "_path.*")


def drop_duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``columns``: duplicates are combined map-side first."""
    return df.select(*[col(c) for c in columns]).distinct()


def wells_per_area(pairs: DataFrame, area: str = "Area", key: str = "API14", top: int = 20) -> DataFrame:
    counts = pairs.groupBy(col(area)).agg(F.count(col(key)).alias(key))
    return counts.orderBy(col(key).desc(), col(area)).limit(top)


def ring_edges(ring: Column) -> Column:
    """The edges of a closed ring as structs ``(ax, ay, bx, by)``."""
    steps = F.filter(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: i < F.size(ring) - 1)
    return F.transform(
        steps,
        lambda i: F.struct(
            ring[i]["x"].alias("ax"), ring[i]["y"].alias("ay"), ring[i + 1]["x"].alias("bx"), ring[i + 1]["y"].alias("by")
        ),
    )


def _cross(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def segments_touch(edge: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether an edge and a segment share a point, shared end points and collinear overlap included.

    Overlapping boxes plus each one's ends not strictly on one side of the other is exact for all cases.
    """
    ax, ay, bx, by = edge["ax"], edge["ay"], edge["bx"], edge["by"]
    boxes = (
        (F.least(ax, bx) <= F.greatest(x1, x2)) & (F.least(x1, x2) <= F.greatest(ax, bx))
        & (F.least(ay, by) <= F.greatest(y1, y2)) & (F.least(y1, y2) <= F.greatest(ay, by))
    )
    ends_of_segment = _cross(ax, ay, bx, by, x1, y1) * _cross(ax, ay, bx, by, x2, y2) <= 0
    ends_of_edge = _cross(x1, y1, x2, y2, ax, ay) * _cross(x1, y1, x2, y2, bx, by) <= 0
    return boxes & ends_of_segment & ends_of_edge


def point_inside(edges: Column, x: Column, y: Column) -> Column:
    """Ray casting: an odd number of edges lies to the right of the point."""
    crossed = F.filter(
        edges,
        lambda e: ((e["ay"] > y) != (e["by"] > y))
        & (x < F.try_divide((e["bx"] - e["ax"]) * (y - e["ay"]), e["by"] - e["ay"]) + e["ax"]),
    )
    return F.size(crossed) % 2 == 1


def path_meets_ring(edges: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """A segment meets a polygon when it touches an edge, or lies inside (then so does its first end)."""
    return F.exists(edges, lambda e: segments_touch(e, x1, y1, x2, y2)) | point_inside(edges, x1, y1)


def _possible(*coordinates: Column) -> Column:
    return reduce(and_, [F.coalesce(F.abs(c) <= LARGEST_COORDINATE, F.lit(False)) & ~F.isnan(c) for c in coordinates])


def _own_level(cell: float) -> Column:
    """The finest grid level on which the box ``bx1, by1, bx2, by2`` spans a bounded number of cells."""
    span = F.greatest(F.col("bx2") - F.col("bx1"), F.col("by2") - F.col("by1")) / F.lit(cell * AXIS_CELLS)
    return F.when(span > 1, F.ceil(F.log2(span))).otherwise(F.lit(0)).cast("int")


def _levels(boxes: DataFrame) -> list[int]:
    """The levels in use: a few dozen numbers at most."""
    return sorted(boxes.agg(F.collect_set("_level")).head()[0])


def _cells(boxes: DataFrame, cell: float, others: Sequence[int]) -> DataFrame:
    """One row per grid cell of the box, on its own level and on each coarser one that the other side uses."""
    coarser = F.filter(F.array(*[F.lit(n) for n in others]) if others else F.array().cast("array<int>"), lambda n: n > F.col("_level"))
    laid = boxes.withColumn("_at", F.explode(F.concat(F.array("_level"), coarser)))
    size = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_at"))

    def span(low: str, high: str) -> Column:
        return F.sequence(F.floor(F.col(low) / size), F.floor(F.col(high) / size))

    return laid.withColumn("_cx", F.explode(span("bx1", "bx2"))).withColumn("_cy", F.explode(span("by1", "by2")))


def spatial_join(
    areas: DataFrame,
    wells: DataFrame,
    area_columns: Sequence[str] = ("Area",),
    well_columns: Sequence[str] = ("API14",),
    ring: str = "ring",
    cell: float = CELL,
    hot_rows: int = HOT_ROWS,
    broadcast_points: int = BROADCAST_POINTS,
) -> DataFrame:
    """Inner join of areas and well paths that intersect.

    Both sides are laid on a grid by their bounding boxes and meet by cell, an equi join. A box that spans many
    cells is laid on a coarser level of the grid, so no shape has more than some hundred cells, and a pair meets
    on the coarser of its two levels. It is tested only in the cell that holds the lower corner of the common
    box, so it appears once and no ``distinct`` is needed. Shapes with a coordinate that is missing, not finite
    or beyond ``LARGEST_COORDINATE`` meet nothing. Areas of a checked size are broadcast; otherwise the wells of crowded
    cells are spread over salts.
    """
    edges = ring_edges(col(ring))
    boxed_areas = (
        areas.where(F.size(col(ring)) > 1).select(
            *[col(c) for c in area_columns],
            edges.alias("_edges"),
            F.array_min(F.transform(col(ring), lambda p: p["x"])).alias("bx1"),
            F.array_min(F.transform(col(ring), lambda p: p["y"])).alias("by1"),
            F.array_max(F.transform(col(ring), lambda p: p["x"])).alias("bx2"),
            F.array_max(F.transform(col(ring), lambda p: p["y"])).alias("by2"),
        )
        .where(_possible(*[F.col(c) for c in BOX]))
        .withColumn("_level", _own_level(cell))
    )
    boxed_wells = (
        wells.where(_possible(*[F.col(c) for c in PATH])).select(
            *[col(c) for c in well_columns],
            *PATH,
            F.least("x1", "x2").alias("bx1"),
            F.least("y1", "y2").alias("by1"),
            F.greatest("x1", "x2").alias("bx2"),
            F.greatest("y1", "y2").alias("by2"),
        )
        .withColumn("_level", _own_level(cell))
    )
    row = boxed_areas.agg(F.sum(F.size("_edges")), F.collect_set("_level")).head()
    points, area_levels = row[0] or 0, sorted(row[1])
    renamed = {"bx1": "_ax1", "by1": "_ay1", "bx2": "_ax2", "by2": "_ay2", "_level": "_area_level"}
    laid_areas = _cells(boxed_areas, cell, _levels(boxed_wells)).withColumnsRenamed(renamed)
    laid_wells = _cells(boxed_wells, cell, area_levels)
    keys = ["_at", "_cx", "_cy"]
    if points <= broadcast_points:
        laid_areas = F.broadcast(laid_areas)
    else:
        crowded = laid_wells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
        salts = broadcast_if_small(crowded.select(*keys, F.ceil(F.col("n") / hot_rows).cast("int").alias("_salts")))
        laid_areas = laid_areas.join(salts, keys, "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
        ).drop("_salts")
        spread = F.xxhash64(F.spark_partition_id(), *PATH, *[col(c) for c in well_columns])
        laid_wells = laid_wells.join(salts, keys, "left").withColumn(
            "_salt", F.pmod(spread, F.coalesce("_salts", F.lit(1))).cast("int")
        ).drop("_salts")
        keys = [*keys, "_salt"]
    size = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_at"))
    lower_corner = (
        (F.col("_at") == F.greatest("_area_level", "_level"))
        & (F.col("_cx") == F.floor(F.greatest("_ax1", "bx1") / size))
        & (F.col("_cy") == F.floor(F.greatest("_ay1", "by1") / size))
    )
    meets = path_meets_ring(F.col("_edges"), *[F.col(c) for c in PATH])
    return laid_wells.join(laid_areas, keys).where(lower_corner & meets).select(
        *[col(c) for c in area_columns], *[col(c) for c in well_columns]
    )


def centroids(areas: DataFrame, area_columns: Sequence[str] = ("Area",), ring: str = "ring") -> DataFrame:
    """Centroid of each ring by the shoelace sums over its edges; of a ring without area, that of its outline.

    Coordinates are taken relative to the first point, which keeps small polygons far from the origin exact.
    """
    origin = col(ring)[0]
    moved = areas.select(
        *[col(c) for c in area_columns],
        origin["x"].alias("_x0"),
        origin["y"].alias("_y0"),
        F.transform(
            ring_edges(col(ring)),
            lambda e: F.struct(
                (e["ax"] - origin["x"]).alias("ax"), (e["ay"] - origin["y"]).alias("ay"),
                (e["bx"] - origin["x"]).alias("bx"), (e["by"] - origin["y"]).alias("by"),
            ),
        ).alias("_edges"),
    )

    def total(term) -> Column:
        return F.aggregate("_edges", F.lit(0.0), lambda s, e: s + term(e))

    def doubled_area(e: Column) -> Column:
        return e["ax"] * e["by"] - e["bx"] * e["ay"]

    def length(e: Column) -> Column:
        return F.hypot(e["bx"] - e["ax"], e["by"] - e["ay"])

    doubled, outline = total(doubled_area), total(length)

    def centre(a: str, b: str, start: str) -> Column:
        of_area = F.try_divide(total(lambda e: (e[a] + e[b]) * doubled_area(e)), 3 * doubled)
        of_outline = F.coalesce(F.try_divide(total(lambda e: (e[a] + e[b]) * length(e)), 2 * outline), F.lit(0.0))
        return F.when(doubled == 0, of_outline).otherwise(of_area) + F.col(start)

    x, y = centre("ax", "bx", "_x0"), centre("ay", "by", "_y0")
    return moved.select(*[col(c) for c in area_columns], y.alias("latitude"), x.alias("longitude"))


def basin_areas(areas: DataFrame, basin: str | None = None, basin_column: str = "Basin") -> DataFrame:
    """Centroids beside the area columns; with ``basin``, its areas only and their NAME as an integer."""
    if basin is not None:
        areas = areas.where(col(basin_column) == F.lit(basin))
        if "Name" in areas.columns and "NAME" not in areas.columns:
            areas = areas.withColumnRenamed("Name", "NAME")
        areas = areas.withColumn("NAME", col("NAME").cast("int"))
    kept = [c for c in areas.columns if c != "ring"]
    return centroids(areas, kept)
