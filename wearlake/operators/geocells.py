"""Radius joins of many centres: points lie in one grid cell, a circle covers a few, and cells are the join key.

Rows of cells are bands of latitude; a band has as many cells as keep them about square, and they run on over the date
line.  A circle over a pole covers its bands whole.  Only pairs that share a cell are measured.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlake.functions import geo


def _across(row: Column, degrees: float) -> Column:
    """Cells of a band: by the edge nearer to the equator."""
    low, high = row * degrees - 90, (row + 1) * degrees - 90
    edge = F.when((low <= 0) & (high >= 0), F.lit(0.0)).otherwise(F.least(F.abs(low), F.abs(high)))
    return F.greatest(F.lit(1), F.floor(360 / degrees * F.cos(F.radians(edge)))).cast("int")


def _column(lon: Column, across: Column) -> Column:
    share = ((lon + 180) % 360 + 360) % 360 / 360
    return F.least(F.floor(share * across), across - 1).cast("int")


def _row(lat: Column, degrees: float) -> Column:
    last = math.ceil(180 / degrees) - 1
    return F.greatest(F.lit(0), F.least(F.floor((lat + 90) / degrees), F.lit(last))).cast("int")


def cell(lat: Column, lon: Column, degrees: float) -> Column:
    """The cell (row, place) of a point; null without coordinates or with a latitude that there isn't."""
    row = _row(lat, degrees)
    inside = lat.between(-90, 90) & lon.isNotNull() & ~F.isnan(lon)
    return F.when(inside, F.struct(row.alias("row"), _column(lon, _across(row, degrees)).alias("place")))


def cover(lat: Column, lon: Column, metres: Column, degrees: float) -> Column:
    """The cells (row, place), each once, that hold every point within ``metres`` of a centre on the ellipsoid."""
    # no direction has a smaller radius of curvature, so an arc is at most this angle; a little room for rounding
    angle = F.degrees(metres / geo.LEAST_RADIUS_M) * 1.001 + 1e-6
    rows = F.sequence(_row(lat - angle, degrees), _row(lat + angle, degrees))
    polar = F.abs(lat) + angle >= 89.9
    # the widest difference in longitude of a circle lies where it touches a meridian
    wide = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.least(angle, F.lit(90.0)))) / F.cos(F.radians(lat))))) * 1.01 + 1e-6

    def places(row: Column) -> Column:
        across = _across(row, degrees)
        each = 360 / across
        first = F.floor((lon - wide + 180) / each)
        last = F.floor((lon + wide + 180) / each)
        some = F.transform(F.sequence(first, last), lambda p: F.pmod(p, across).cast("int"))
        whole = F.sequence(F.lit(0), across - 1)
        held = F.when(polar | (2 * wide >= 360 - each), whole).otherwise(F.array_distinct(some))
        return F.transform(held, lambda p: F.struct(row.alias("row"), p.alias("place")))

    there = lat.between(-90, 90) & lon.isNotNull() & ~F.isnan(lon) & (metres >= 0)
    return F.when(there, F.flatten(F.transform(rows, places)))


def cell_size(metres: float) -> float:
    """Degrees of a cell for circles of that radius: a circle covers some nine cells."""
    return min(30.0, max(0.001, math.degrees(metres / geo.LEAST_RADIUS_M)))


def _places(df: DataFrame, *columns: str) -> DataFrame:
    """The distinct values of columns; of equal doubles one stands for all."""
    return df.select(*columns).distinct()


def within(
    centres: DataFrame, points: DataFrame, metres: float | Column, degrees: float | None = None, centre: str = "centre_id", key: str = "id"
) -> DataFrame:
    """(centre, key, distance_m) of all pairs at most ``metres`` apart on the ellipsoid; both have lat and lon.

    ``metres`` may be a column of the centres; cells then suit the largest.  Points or centres without a place pair
    with nothing.  Distances are measured once for each pair of places, of which many rows may share one; only pairs that
    are near are then written out for their rows.  A crowded cell or place is a join key that Spark may split; places of
    points come once, circles in some nine cells.
    """
    radius = metres if isinstance(metres, Column) else F.lit(float(metres))
    own = centres.select(F.col(centre), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), radius.alias("_metres"))
    if degrees is None:
        degrees = cell_size(own.agg(F.max("_metres")).first()[0] or 1.0 if isinstance(metres, Column) else float(metres))
    asked = _places(own, "_lat", "_lon", "_metres").withColumn("_cell", F.explode(cover(F.col("_lat"), F.col("_lon"), F.col("_metres"), degrees)))
    held = _places(points, "lat", "lon").withColumn("_cell", cell(F.col("lat"), F.col("lon"), degrees)).filter("_cell is not null")
    pairs = asked.join(held, "_cell")
    far = geo.geodesic(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon"))
    # a great circle of the smallest radius of curvature is a cheap lower bound
    near = geo.haversine(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon")) * (0.99 * geo.LEAST_RADIUS_M / geo.EARTH_M) <= F.col("_metres")
    close = pairs.filter(near).withColumn("distance_m", far).filter(F.col("distance_m") <= F.col("_metres")).drop("_cell")
    return close.join(own, ["_lat", "_lon", "_metres"]).join(points.select(F.col(key), "lat", "lon"), ["lat", "lon"]).select(centre, key, "distance_m")
