"""Geographic column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wearlake.functions import formats

EARTH_M = 6_371_000.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres, null if a coordinate is; the half-chord is clamped to [0, 1]."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    a = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.when(a < 0, 0.0).when(a > 1, 1.0).otherwise(a)))  # greatest and least would pass over nulls


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing in [0, 360)."""
    turn = F.radians(lon2 - lon1)
    y = F.sin(turn) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(turn)
    return (F.degrees(F.atan2(y, x)) + 360.0) % 360.0


def cyclic(heading: Column) -> tuple[Column, Column]:
    """Sine and cosine of degrees."""
    return F.sin(F.radians(heading)), F.cos(F.radians(heading))


def speed_share(kmh: Column, fastest: float = 120.0) -> Column:
    """Part of the fastest speed, in [0, 1]; null of null."""
    return F.when(kmh < 0, 0.0).when(kmh > fastest, 1.0).otherwise(kmh / fastest)


def tile_name(lat: Column, lon: Column) -> Column:
    """``tile_<lat>_<lon>`` with 3 decimals of the exact binary values."""
    return F.concat(F.lit("tile_"), formats.fixed(lat, 3), F.lit("_"), formats.fixed(lon, 3))


def place_name(lookup: Column, lat: Column, lon: Column) -> Column:
    """Of a struct found for a place, the neighbourhood, else suburb, city_district, city, else the first 60 characters of
    display_name; without any, the tile."""
    named = [F.nullif(lookup[c], F.lit("")) for c in ("neighbourhood", "suburb", "city_district", "city")]
    return F.coalesce(*named, F.nullif(F.substring(lookup["display_name"], 1, 60), F.lit("")), tile_name(lat, lon))


def wkt_point(lat: Column, lon: Column) -> Column:
    return F.concat(F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def wkt_line(points: Column) -> Column:
    """LINESTRING of an array of (lat, lon) structs; null under two points."""
    body = F.array_join(
        F.transform(points, lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string"))), ", "
    )
    return F.when(F.size(points) >= 2, F.concat(F.lit("LINESTRING("), body, F.lit(")")))


# fixed values: the WGS 84 ellipsoid
AXIS_M, FLATTENING = 6_378_137.0, 1 / 298.257223563
POLE_M = AXIS_M * (1 - FLATTENING)
#: The smallest radius of curvature of the ellipsoid, along the meridian at the equator.
LEAST_RADIUS_M = AXIS_M * (1 - FLATTENING) ** 2


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def geodesic(lat1: Column, lon1: Column, lat2: Column, lon2: Column, steps: int = 8) -> Column:
    """Metres along the ellipsoid, null if a coordinate is: the longitude difference on the auxiliary sphere by a fixed
    number of steps, then the series in the flattening.

    A step shrinks the error of the difference by about the flattening (300), so that 8 steps leave rounding, and the
    series less than 0.1 mm, up to about 19,900 km.  Beyond, nearly opposite points don't settle; where the last step
    changed more than 1e-9 the result is the great circle of the mean radius, within 0.6 %.
    """
    f = FLATTENING
    reduced = lambda lat: F.atan((1 - f) * F.tan(F.radians(lat)))
    turn = F.radians(((lon2 - lon1 + 540) % 360 + 360) % 360 - 180)
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    start = F.struct(
        F.sin(reduced(lat1)).alias("s1"), F.cos(reduced(lat1)).alias("c1"), F.sin(reduced(lat2)).alias("s2"),
        F.cos(reduced(lat2)).alias("c2"), turn.alias("turn"),
    )

    def arc(k: Column, lam: Column) -> Column:
        """Sine, cosine and angle of the arc, its squared cosine of azimuth at the equator and its doubled middle."""
        sine = F.hypot(k["c2"] * F.sin(lam), k["c1"] * k["s2"] - k["s1"] * k["c2"] * F.cos(lam))
        both = F.struct(sine.alias("ss"), (k["s1"] * k["s2"] + k["c1"] * k["c2"] * F.cos(lam)).alias("cs"), lam.alias("lam"))

        def azimuth(p: Column) -> Column:
            sa = F.when(p["ss"] > 0, k["c1"] * k["c2"] * F.sin(p["lam"]) / p["ss"]).otherwise(F.lit(0.0))
            return _let(
                F.struct(p["ss"].alias("ss"), p["cs"].alias("cs"), F.atan2(p["ss"], p["cs"]).alias("sigma"), sa.alias("sa"), (1 - sa * sa).alias("c2a")),
                lambda q: F.struct(
                    q["ss"].alias("ss"), q["cs"].alias("cs"), q["sigma"].alias("sigma"), q["sa"].alias("sa"), q["c2a"].alias("c2a"),
                    F.when(q["c2a"] > 1e-15, q["cs"] - 2 * k["s1"] * k["s2"] / q["c2a"]).otherwise(F.lit(0.0)).alias("cm"),
                ),
            )

        return _let(both, azimuth)

    def step(k: Column, state: Column) -> Column:
        def moved(p: Column) -> Column:
            c = f / 16 * p["c2a"] * (4 + f * (4 - 3 * p["c2a"]))
            lam = k["turn"] + (1 - c) * f * p["sa"] * (
                p["sigma"] + c * p["ss"] * (p["cm"] + c * p["cs"] * (2 * p["cm"] * p["cm"] - 1))
            )
            return F.struct(lam.alias("lam"), F.abs(lam - state["lam"]).alias("change"))

        return _let(arc(k, state["lam"]), moved)

    def measured(p: Column) -> Column:
        u = p["c2a"] * ((AXIS_M**2 - POLE_M**2) / POLE_M**2)
        big = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
        small = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
        cm, cs, ss = p["cm"], p["cs"], p["ss"]
        off = small * ss * (
            cm + small / 4 * (cs * (2 * cm * cm - 1) - small / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3))
        )
        return F.lit(POLE_M) * big * (p["sigma"] - off)

    def whole(k: Column) -> Column:
        first = F.struct(k["turn"].alias("lam"), F.lit(9.0).alias("change"))
        settled = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first, lambda state, _: step(k, state))
        return _let(
            settled,
            lambda s: F.when(s["change"] < 1e-9, _let(arc(k, s["lam"]), measured)).otherwise(haversine(lat1, lon1, lat2, lon2)),
        )

    return F.when(known, _let(start, whole))
