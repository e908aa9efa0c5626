"""Episode catalogue: search, statistics, upsert and delete over DataFrames."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlake.functions import geo, vector


def semantic_top_k(
    df: DataFrame, query: list[float], k: int, column: str = "embedding", key: str = "id", where: Column | None = None
) -> DataFrame:
    """The k rows of highest cosine to a query vector; ties by key, null vectors left out."""
    rows = df.filter(F.col(column).isNotNull())
    rows = rows.filter(where) if where is not None else rows
    return rows.withColumn(
        "similarity", vector.cosine(F.col(column), F.array(*(F.lit(float(x)) for x in query)))
    ).orderBy(F.desc("similarity"), key).limit(k)


def geo_radius(df: DataFrame, lat: float, lon: float, metres: float, key: str = "id") -> DataFrame:
    """Rows within a radius, nearest first; a band of latitudes and, away from poles and date line, of longitudes is filtered before the distance."""
    band = metres / 111_000.0
    near = df.filter(F.col("lat").between(lat - band, lat + band))
    if abs(lat) + band < 89:
        # the widest difference in longitude of a circle
        side = math.degrees(
            math.asin(min(1.0, math.sin(min(metres / geo.EARTH_M, math.pi / 2)) / math.cos(math.radians(lat))))
        ) * 1.001 + 1e-9
        if abs(lon) + side < 180 and metres / geo.EARTH_M < 1:
            near = near.filter(F.col("lon").between(lon - side, lon + side))
    return near.withColumn(
        "distance_m", geo.haversine(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"))
    ).filter(F.col("distance_m") <= metres).orderBy("distance_m", key)


def text_search(df: DataFrame, phrase: str, k: int, columns: list[str], key: str = "id") -> DataFrame:
    """Rows with the phrase in any column, whatever its case, in key order; % and _ are ordinary characters."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.lower(c).contains(phrase.lower()), F.lit(False))
    return df.filter(hit).orderBy(key).limit(k)


def stats_by(df: DataFrame, column: str, session: str, seconds: str) -> DataFrame:
    """Totals per value of a column and over all (``is_total``), by ROLLUP; a null value's own group is left out."""
    rolled = df.rollup(column).agg(
        F.grouping(column).cast("int").alias("is_total"), F.count("*").alias("episodes"), F.countDistinct(session).alias("sessions"),
        F.coalesce(F.sum(seconds), F.lit(0.0)).alias("seconds"),
    )
    return rolled.filter(
        (F.col("is_total") == 1) | F.col(column).isNotNull()
    ).withColumn("hours", F.col("seconds") / 3600)


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """Rows of both; for a key the new row wins, among new rows the latest by ``order``."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy(F.desc("_new"), F.desc(order))
    return both.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_new")


def delete(df: DataFrame, where: Column) -> tuple[DataFrame, int]:
    """The rows that stay, and how many go.  A null condition keeps its row."""
    goes = F.coalesce(where, F.lit(False))
    return df.filter(~goes), df.filter(goes).count()


def cascade(children: DataFrame, deleted: DataFrame, on: str) -> DataFrame:
    """Children whose parent isn't among the deleted."""
    return children.join(deleted.select(on).distinct(), on, "left_anti")


def dataset_stats(episodes: DataFrame, fps: float = 30.0) -> DataFrame:
    """One row: episodes, frames, seconds, distinct non-empty sessions, distinct two-character language prefixes."""
    prefix = F.substring("instruction", 1, 2)
    return episodes.agg(
        F.count("*").alias("episodes"), F.coalesce(F.sum("frames"), F.lit(0)).alias("frames"), F.coalesce(
            F.sum(F.col("frames") / fps), F.lit(0.0)
        ).alias("seconds"),
        F.countDistinct(F.when(F.col("session") != "", F.col("session"))).alias("sessions"), F.array_join(
            F.array_sort(F.collect_set(F.when(prefix != "", prefix))), ","
        ).alias("languages"),
    )


def session_summary(sessions: DataFrame) -> DataFrame:
    """Seconds rounded to 2 places (missing ends count as 0), the language or ?, and whether it has_video, has_audio
    and has_imu, false where the column is missing or null; a missing id is ?, missing video_frames 0."""
    flags = {
        f: F.coalesce(F.col(f), F.lit(False))
        if f in sessions.columns
        else F.lit(False)
        for f in ("has_video", "has_audio", "has_imu")
    }
    seconds = F.bround(F.coalesce("end_time", F.lit(0.0)) - F.coalesce("start_time", F.lit(0.0)), 2)
    named = {"session_id": F.coalesce("session_id", F.lit("?")), "video_frames": F.coalesce("video_frames", F.lit(0))}
    named = {c: v for c, v in named.items() if c in sessions.columns}
    return sessions.withColumns({"duration": seconds, "language": F.coalesce("language", F.lit("?"))} | named | flags)


def find_session(sessions: DataFrame, session_id: str) -> DataFrame:
    """The sessions of an id; none is an empty result."""
    return sessions.filter(F.col("session_id") == session_id)


def top_values(df: DataFrame, column: str, k: int = 3, part: str | None = None) -> DataFrame:
    """The k most frequent values (n; equal counts by value) of all rows or of each ``part``; nulls don't count."""
    keys = [part] if part else []
    n = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("n"))
    if not part:
        return n.orderBy(F.desc("n"), column).limit(k)
    return n.withColumn(
        "_n", F.row_number().over(Window.partitionBy(part).orderBy(F.desc("n"), column))
    ).filter(F.col("_n") <= k).drop("_n")


def gps_summary(fixes: DataFrame, part: str = "session", k: int = 3) -> DataFrame:
    """Points, largest ``total_m`` to one place, and the k most frequent places of each session as an array of (n, place_name)."""
    top = top_values(fixes, "place_name", k, part).groupBy(part).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "place_name"))).alias("_t")
    )
    places = F.transform("_t", lambda x: F.struct((-x["n"]).alias("n"), x["place_name"].alias("place_name")))
    whole = fixes.groupBy(part).agg(
        F.count("*").alias("num_points"), F.bround(F.coalesce(F.max("total_m"), F.lit(0.0)), 1).alias("total_dist_m")
    )
    return whole.join(top, part, "left").withColumn("top_places", places).drop("_t")


def tag_places(fixes: DataFrame, places: DataFrame | None = None, digits: int = 4) -> DataFrame:
    """place_name of fixes: from a table of looked-up places (lat_r, lon_r rounded to ``digits``, place), else the tile's name."""
    rounded = fixes.withColumns({"lat_r": F.bround("lat", digits), "lon_r": F.bround("lon", digits)})
    if places is None:
        return fixes.withColumn("place_name", geo.tile_name(F.col("lat"), F.col("lon")))
    found = rounded.join(places.dropDuplicates(["lat_r", "lon_r"]), ["lat_r", "lon_r"], "left")
    return found.withColumn(
        "place_name", geo.place_name(F.col("place"), F.col("lat"), F.col("lon"))
    ).drop("lat_r", "lon_r", "place")


def places_wanted(fixes: DataFrame, digits: int = 4) -> DataFrame:
    """Each rounded position once, to be looked up outside."""
    return fixes.select(F.bround("lat", digits).alias("lat_r"), F.bround("lon", digits).alias("lon_r")).distinct()


def session_scenario(fixes: DataFrame, default: str = "general", part: str = "session") -> DataFrame:
    """Mean speed of each session and the scenario that it suggests."""
    kind = F.when(F.col("mean_kmh") > 15, "driving").when(F.col("mean_kmh") > 3, "food_delivery").otherwise(default)
    return fixes.groupBy(part).agg(F.avg("speed_kmh").alias("mean_kmh")).withColumn("scenario", kind)
