"""Plane geometry on columns. A box is a struct of xmin, ymin, xmax, ymax; a ring an array of structs x, y, closed; a
polygon an array of rings, shell first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return F.struct(xmin.alias("xmin"), ymin.alias("ymin"), xmax.alias("xmax"), ymax.alias("ymax"))


def box_ring(b: str) -> Column:
    """The closed ring of a box, counter-clockwise."""
    p = lambda x, y: F.struct(F.col(f"{b}.{x}").alias("x"), F.col(f"{b}.{y}").alias("y"))
    return F.array(p("xmin", "ymin"), p("xmax", "ymin"), p("xmax", "ymax"), p("xmin", "ymax"), p("xmin", "ymin"))


def ring_area(ring: Column) -> Column:
    """Area of a closed ring, by the shoelace sum over its edges."""
    edges = F.transform(
        F.slice(ring, 1, F.size(ring) - 1), lambda p, i: p["x"] * F.get(ring, i + 1)["y"] - F.get(ring, i + 1)["x"] * p["y"]
    )
    return F.abs(F.aggregate(edges, F.lit(0.0), lambda a, x: a + x)) / 2


def ring_length(ring: Column) -> Column:
    """Length of a closed ring."""
    step = lambda p, i: F.hypot(p["x"] - F.get(ring, i + 1)["x"], p["y"] - F.get(ring, i + 1)["y"])
    return F.aggregate(F.transform(F.slice(ring, 1, F.size(ring) - 1), step), F.lit(0.0), lambda a, x: a + x)


def polygon_area(rings: Column) -> Column:
    """Area of the shell less its holes."""
    areas = F.transform(rings, ring_area)
    return F.aggregate(areas, F.lit(0.0), lambda a, x: a - x) + 2 * F.get(areas, F.lit(0))


def compactness(area: Column, length: Column) -> Column:
    """4 pi area / length squared: 1 for a disc."""
    return F.try_divide(4 * F.pi() * area, length * length)


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies within a closed ring: a ray to the right crosses it an odd number of times."""

    def crosses(p: Column, i: Column) -> Column:
        q = F.get(ring, i + 1)
        spans = (p["y"] > y) != (q["y"] > y)
        at = p["x"] + (y - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) * (q["x"] - p["x"])
        return F.when(spans & (x < at), 1).otherwise(0)

    hits = F.transform(F.slice(ring, 1, F.size(ring) - 1), crosses)
    return F.aggregate(hits, F.lit(0), lambda a, h: a + h) % 2 == 1


def overlap_area(a: str, b: str) -> Column:
    """Area that two boxes share."""
    w = F.least(f"{a}.xmax", f"{b}.xmax") - F.greatest(f"{a}.xmin", f"{b}.xmin")
    h = F.least(f"{a}.ymax", f"{b}.ymax") - F.greatest(f"{a}.ymin", f"{b}.ymin")
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def shared_box(a: str, b: str) -> Column:
    """The box that two meeting boxes share."""
    return box(F.greatest(f"{a}.xmin", f"{b}.xmin"), F.greatest(f"{a}.ymin", f"{b}.ymin"), F.least(f"{a}.xmax", f"{b}.xmax"), F.least(f"{a}.ymax", f"{b}.ymax"))


def box_distance(a: str, b: str) -> Column:
    """Distance between two boxes; 0 where they meet."""
    dx = F.greatest(F.col(f"{b}.xmin") - F.col(f"{a}.xmax"), F.col(f"{a}.xmin") - F.col(f"{b}.xmax"), F.lit(0.0))
    dy = F.greatest(F.col(f"{b}.ymin") - F.col(f"{a}.ymax"), F.col(f"{a}.ymin") - F.col(f"{b}.ymax"), F.lit(0.0))
    return F.hypot(dx, dy)


# Eccentricity, exponent, constant, origin and meridian of the projection.
_LAMBERT = (0.08181919112, 0.7256077650, 11754255.426, 700000.0, 12655612.050, 3.0)


def lambert93_inverse(x: Column, y: Column, rounds: int = 6) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of an easting and northing: the latitude by a fixed number of rounds, each of
    which leaves less than a hundredth of the error."""
    e, n, c, xs, ys, lon0 = _LAMBERT
    r, g = F.hypot(x - xs, ys - y), F.atan2(x - xs, ys - y)
    grown = F.exp(-F.log(r / c) / n)
    phi = 2 * F.atan(grown) - F.pi() / 2
    for _ in range(rounds):
        sine = e * F.sin(phi)
        phi = 2 * F.atan(grown * F.pow((1 + sine) / (1 - sine), F.lit(e / 2))) - F.pi() / 2
    return lon0 + F.degrees(g / n), F.degrees(phi)


def lambert93(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in metres of a longitude and latitude in degrees (conic conformal, two parallels)."""
    e, n, c, xs, ys, lon0 = _LAMBERT
    phi = F.radians(lat)
    sine = e * F.sin(phi)
    iso = F.log(F.tan(F.pi() / 4 + phi / 2) * F.pow((1 - sine) / (1 + sine), F.lit(e / 2)))
    r, g = c * F.exp(-n * iso), n * F.radians(lon - lon0)
    return xs + r * F.sin(g), ys - r * F.cos(g)


def cells(b: str, size: float, grow: float = 0.0) -> Column:
    """The grid cells that a box touches when grown on all sides."""
    span = lambda lo, hi: F.sequence(F.floor((F.col(f"{b}.{lo}") - grow) / size), F.floor((F.col(f"{b}.{hi}") + grow) / size))
    rows = lambda x: F.transform(span("ymin", "ymax"), lambda y: F.struct(x.alias("cx"), y.alias("cy")))
    return F.flatten(F.transform(span("xmin", "xmax"), rows))


def grid_join(left: DataFrame, right: DataFrame, lbox: str, rbox: str, size: float, within: float = 0.0) -> DataFrame:
    """Pairs whose boxes lie within a distance: both sides are dealt to grid cells and joined on the cell. A pair that
    shares several cells comes out of the first one only, so no distinct is needed. Columns must not clash.

    The work follows the number of boxes a cell; ``size`` should be near the usual extent plus ``within``."""
    a = left.withColumn("_lc", F.explode(cells(lbox, size, within)))
    b = right.withColumn("_rc", F.explode(cells(rbox, size)))
    first = lambda lo: F.floor(F.greatest(F.col(f"{lbox}.{lo}") - within, F.col(f"{rbox}.{lo}")) / size)
    near = box_distance(lbox, rbox) <= within if within else (
        (F.col(f"{lbox}.xmin") <= F.col(f"{rbox}.xmax")) & (F.col(f"{rbox}.xmin") <= F.col(f"{lbox}.xmax")) & (F.col(f"{lbox}.ymin") <= F.col(f"{rbox}.ymax")) & (F.col(f"{rbox}.ymin") <= F.col(f"{lbox}.ymax"))
    )
    one = (F.col("_lc.cx") == first("xmin")) & (F.col("_lc.cy") == first("ymin"))
    return a.join(b, F.col("_lc") == F.col("_rc")).where(near & one).drop("_lc", "_rc")


def k_nearest(pairs: DataFrame, keys: Sequence[str], distance: Column, tie: str, k: int) -> DataFrame:
    """The k nearest partners of each key among candidate pairs, with their distance."""
    from pyspark.sql import Window

    rows = pairs.withColumn("distance", distance)
    order = Window.partitionBy(*keys).orderBy("distance", tie)
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
