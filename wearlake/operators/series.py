"""Ordered operators on sensor series: a series is the rows of one partition key in the order of a time column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlake.functions import formats, geo


#: Numbers that one row writes out at a time, and the most runs of a range: more (163 billion numbers) are a damaged end.
RUN, MOST_RUNS = 16_384, 10_000_000


def _order(part: str, t: str, tie: str | None = None):
    return Window.partitionBy(part).orderBy(t, *([tie] if tie else []))


def numbered(df: DataFrame, first: Column, last: Column, name: str, run: int = RUN, spread: bool = False) -> DataFrame:
    """df once for each whole number from ``first`` to ``last``, which becomes ``name``; none where that is less or null.

    Numbers are written out in runs of ``run``, so that a long range is never one array; with ``spread`` the runs of a
    range go to different tasks.  Over ``MOST_RUNS`` runs are an error.  Spark takes the result to be about as large as
    ``df`` and would broadcast it in a join where only ``df`` is small, so it has the hint ``merge``.
    """
    low, high, k = F.col("_low"), F.col("_high"), F.col("_run")
    ends = F.concat(F.lit("a range of numbers is too long: "), low.cast("string"), F.lit(" to "), high.cast("string"))
    count = F.floor((high - low) / run)
    fits = F.when(count < MOST_RUNS, count).otherwise(F.raise_error(ends).cast("long"))
    runs = df.withColumns({"_low": first.cast("long"), "_high": last.cast("long")}).filter(low <= high)
    runs = runs.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), fits)))
    if spread:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        runs = runs.repartition(tasks, F.xxhash64("_low", "_high", "_run", *df.columns))
    one = F.sequence(low + k * run, F.least(low + k * run + run - 1, high))
    return runs.withColumn(name, F.explode(one)).drop("_low", "_high", "_run").hint("merge")


#: Seconds of a block into which a series is cut, so that a long one isn't one task.
BLOCK_S = 3600.0


def _before(column: str, part: str, block: str = "_block") -> Column:
    """The sum of a column over a series' earlier blocks, of one row a block."""
    w = Window.partitionBy(part).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(w), F.lit(0))


def placed(df: DataFrame, part: str = "session", t: str = "t", tie: str | None = None, block: float = BLOCK_S) -> DataFrame:
    """df with _i, a row's number in its series from 0 in the order of time (and ``tie``), and _n, the series' rows.

    Rows are numbered inside blocks of time; only the blocks' counts, a row a block, are summed over a series.
    """
    cut = df.withColumn("_block", F.floor(F.col(t) / block))
    counts = cut.groupBy(part, "_block").agg(F.count("*").alias("_rows"))
    bases = counts.withColumn("_base", _before("_rows", part)).withColumn("_n", F.sum("_rows").over(Window.partitionBy(part))).drop("_rows")
    bases = bases.select(F.col(part).alias("_p"), F.col("_block").alias("_pb"), "_base", "_n")
    inside = F.row_number().over(Window.partitionBy(part, "_block").orderBy(t, *([tie] if tie else [])))
    joined = cut.withColumn("_i", inside).join(bases, F.col(part).eqNullSafe(F.col("_p")) & F.col("_block").eqNullSafe(F.col("_pb")))
    return joined.withColumn("_i", F.col("_i") - 1 + F.col("_base")).drop("_p", "_pb", "_base", "_block")


def _of_blocks(df: DataFrame, found: DataFrame, part: str) -> DataFrame:
    """df with the columns of a table of one row a series and block."""
    names = [c for c in found.columns if c not in (part, "_block")]
    held = found.select(F.col(part).alias("_p"), F.col("_block").alias("_pb"), *names)
    return df.join(held, F.col(part).eqNullSafe(F.col("_p")) & F.col("_block").eqNullSafe(F.col("_pb"))).drop("_p", "_pb")


def _running(df: DataFrame, value: str, name: str, part: str, order: list[str]) -> DataFrame:
    """df (cut into _block) with the sum of a column up to each row of its series: inside the block, and over the blocks before."""
    inside = Window.partitionBy(part, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = df.groupBy(part, "_block").agg(F.sum(value).alias("_sum"))
    bases = sums.select(part, "_block", _before("_sum", part).alias("_base"))
    joined = _of_blocks(df.withColumn("_own", F.sum(value).over(inside)), bases, part)
    return joined.withColumn(name, F.col("_base") + F.col("_own")).drop("_own", "_base")


def motion(
    df: DataFrame, part: str = "session", t: str = "t", tie: str | None = None, block: float = 86_400.0
) -> DataFrame:
    """Distance, speed and heading from the row before, and the distance so far; the first row has 0, 0 and the second's heading.

    Rows of one time are in the order of ``tie``, without it of their coordinates.  A series is worked through in
    blocks of ``block`` seconds; a block is known by its first and last fix and the way between them, one row a block.
    """
    order = [t, *([tie] if tie else ["lat", "lon"])]
    own = F.struct(*(F.col(c).alias(f"_o{k}") for k, c in enumerate(order)), "lat", "lon")
    way = lambda a, b: geo.haversine(a["lat"], a["lon"], b["lat"], b["lon"])
    course = lambda a, b: geo.bearing(a["lat"], a["lon"], b["lat"], b["lon"])
    v, before, after = F.col("_v"), F.col("_prev"), F.col("_next")
    w = Window.partitionBy(part, "_block").orderBy(*order)
    cut = df.withColumn("_block", F.floor(F.col(t) / block)).withColumn("_v", own)
    cut = cut.withColumns({"_prev": F.lag("_v").over(w), "_next": F.lead("_v").over(w)})
    cut = cut.withColumn("_step", F.coalesce(way(before, v), F.lit(0.0)))
    ends = cut.groupBy(part, "_block").agg(
        F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.sum("_step").alias("_inside")
    )
    by = Window.partitionBy(part).orderBy("_block")
    ends = ends.withColumns({"_earlier": F.lag("_high").over(by), "_later": F.lead("_low").over(by)})
    ends = ends.withColumn("_edge", F.coalesce(way(F.col("_earlier"), F.col("_low")), F.lit(0.0)))
    ends = ends.withColumn("_sum", F.col("_inside") + F.col("_edge"))
    base = (_before("_sum", part) + F.col("_edge")).alias("_base")
    near = _of_blocks(cut, ends.select(part, "_block", "_earlier", "_later", base, "_edge"), part)
    inside = F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, 0))
    near = near.withColumn("_total", F.col("_base") + inside).withColumn(
        "_way", F.when(before.isNull(), F.col("_edge")).otherwise(F.col("_step"))
    )
    near = near.withColumns({"_prev": F.coalesce("_prev", "_earlier"), "_next": F.coalesce("_next", "_later")})
    dt = F.greatest(F.col(t) - before["_o0"], F.lit(1e-6))
    new = {
        "distance_m": F.col("_way"), "speed_kmh": F.coalesce(F.col("_way") / dt * 3.6, F.lit(0.0)),
        "heading": F.coalesce(course(before, v), course(v, after), F.lit(0.0)), "total_m": F.col("_total"),
    }
    return near.select(*(c for c in df.columns if c not in new), *(x.alias(c) for c, x in new.items()))


def stationary(
    df: DataFrame, part: str = "session", t: str = "t", speed: str = "speed", below: float = 2.0, seconds: float = 5.0,
    tie: str | None = None, block: float = 86_400.0,
) -> DataFrame:
    """is_stationary: rows of a run below the speed that lasts ``seconds``; segment_id grows at each start of moving.

    Runs are numbered over blocks of ``block`` seconds, of which one row each passes a window of the series, and then
    pre-aggregated, so that neither a long series nor a long run is one task; one row a run passes such a window too.
    """
    order = [t, *([tie] if tie else [speed])]
    names = [c for c in df.columns if c not in ("is_stationary", "segment_id")]
    w = Window.partitionBy(part, "_block").orderBy(*order)
    place = F.struct(*(F.col(c).alias(f"_o{k}") for k, c in enumerate(order)))
    turned = lambda a, b: F.when(F.col(a) != F.col(b), 1).otherwise(0)
    cut = df.withColumn("_slow", F.col(speed) < below).withColumn("_block", F.floor(F.col(t) / block))
    cut = cut.withColumn("_was", F.lag("_slow").over(w)).withColumn("_flip", turned("_slow", "_was"))
    ends = cut.groupBy(part, "_block").agg(
        F.min_by("_slow", place).alias("_low"), F.max_by("_slow", place).alias("_high"), F.sum("_flip").alias("_inside")
    )
    by = Window.partitionBy(part).orderBy("_block")
    ends = ends.withColumn("_earlier", F.lag("_high").over(by)).withColumn("_edge", turned("_low", "_earlier"))
    ends = ends.withColumn("_sum", F.col("_inside") + F.col("_edge"))
    ends = ends.select(part, "_block", (_before("_sum", part) + F.col("_edge")).alias("_base"))
    inside = F.sum("_flip").over(w.rowsBetween(Window.unboundedPreceding, 0))
    runs = _of_blocks(cut.withColumn("_own", inside), ends, part).withColumn("_run", F.col("_base") + F.col("_own"))
    spans = runs.groupBy(part, "_run").agg((F.max(t) - F.min(t) >= seconds).alias("_long"), F.max("_slow").alias("_any"))
    over = Window.partitionBy(part).orderBy("_run")
    # a run that isn't slow, after one that was stationary: runs take turns
    begins = F.when((F.col("_run") > 0) & ~F.col("_any") & F.lag("_long").over(over), 1).otherwise(0)
    told = spans.withColumn("_begins", begins).withColumn(
        "segment_id", F.sum("_begins").over(over.rowsBetween(Window.unboundedPreceding, 0))
    )
    told = told.select(F.col(part).alias("_p"), F.col("_run").alias("_r"), "_long", "segment_id")
    marked = runs.select(*names, "_slow", "_run").join(
        told, F.col(part).eqNullSafe(F.col("_p")) & (F.col("_run") == F.col("_r"))
    )
    return marked.select(*names, (F.col("_slow") & F.col("_long")).alias("is_stationary"), "segment_id")


def _neighbours(
    samples: DataFrame, grid: DataFrame, columns: list[str], part: str, t: str, block: float, tie: str | None
) -> DataFrame:
    """(part, t, _p, _n): for each grid time the last sample at or before it and the first after that, null where there is none.

    A series is cut into blocks of ``block`` seconds, so that a long one isn't one task.  A sample brings the next one of
    its block along, so that one window over samples and grid is enough; the nearest samples outside a block come from
    a window over one row a block.
    """
    of_block, ties = F.floor(F.col(t) / block), [tie] if tie else []
    value = F.struct(F.col(t).alias("t"), *([F.col(tie).alias("tie")] if tie else []), *columns)
    inside = Window.partitionBy(part, "_block").orderBy(t, *ties)
    known = samples.withColumn("_block", of_block).withColumn("_v", value)
    known = known.withColumn("_s", F.struct(F.col("_v").alias("own"), F.lead("_v").over(inside).alias("next")))
    known = known.select(part, t, "_block", F.lit(0).alias("_grid"), *(F.col(c).alias("_tie") for c in ties), "_s")
    asked = grid.select(part, t, of_block.alias("_block"), F.lit(1).alias("_grid"))
    rows = known.unionByName(asked, allowMissingColumns=True)
    order = Window.partitionBy(part, "_block").orderBy(t, "_grid", *("_tie" for _ in ties))
    both = rows.withColumn("_p", F.last("_s", True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    by = Window.partitionBy(part)
    ends = samples.select(part, of_block.alias("_block"), value.alias("_v"))
    ends = ends.unionByName(asked.select(part, "_block"), allowMissingColumns=True)
    ends = ends.groupBy(part, "_block").agg(F.max("_v").alias("_high"), F.min("_v").alias("_low"))
    earlier = F.last("_high", True).over(by.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    later = F.last("_low", True).over(by.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(part, "_block", "_low", earlier.alias("_earlier"), later.alias("_later"))
    joined = both.filter("_grid = 1").join(ends.hint("merge"), [part, "_block"])  # see ``numbered``
    following = F.when(F.col("_p").isNotNull(), F.coalesce("_p.next", "_later")).otherwise(F.coalesce("_low", "_later"))
    return joined.select(part, t, F.coalesce("_p.own", "_earlier").alias("_p"), following.alias("_n"))


def interpolate(
    samples: DataFrame, grid: DataFrame, columns: list[str], part: str = "session", t: str = "t",
    block: float = 86_400.0, tie: str | None = None,
) -> DataFrame:
    """Linear interpolation of samples at grid times, held at the first and last sample outside; of samples of one time the last by ``tie`` counts."""
    both = _neighbours(samples, grid, columns, part, t, block, tie)
    share = (F.col(t) - F.col("_p.t")) / (F.col("_n.t") - F.col("_p.t"))

    def at(c: str) -> Column:
        p, n = F.col(f"_p.{c}"), F.col(f"_n.{c}")
        return F.when(F.col("_p").isNull(), n).when(
            F.col("_n").isNull() | (F.col("_p.t") == F.col(t)), p
        ).otherwise(p + (n - p) * share)

    return both.select(part, t, *(at(c).alias(c) for c in columns))


def as_of(
    samples: DataFrame, grid: DataFrame, columns: list[str], part: str = "session", t: str = "t",
    block: float = 86_400.0, tie: str | None = None,
) -> DataFrame:
    """The latest sample at or before each grid time; before the first, the first."""
    both = _neighbours(samples, grid, columns, part, t, block, tie)
    return both.withColumn("_v", F.coalesce("_p", "_n")).select(part, t, *(F.col(f"_v.{c}").alias(c) for c in columns))


def grid(df: DataFrame, step: float, part: str = "session", t: str = "t", closed: bool = True) -> DataFrame:
    """Times from the first sample every ``step``; closed: until the last one is reached or passed, else before it."""
    ends = df.groupBy(part).agg(F.min(t).alias("_a"), F.max(t).alias("_b"))
    n = F.ceil((F.col("_b") - F.col("_a")) / step).cast("long") + (1 if closed else 0)
    return numbered(ends, F.lit(0), n - 1, "_k", spread=True).select(part, (F.col("_a") + F.col("_k") * step).alias(t))


def first_by_time(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row of each key."""
    return df.withColumn(
        "_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ).filter("_n = 1").drop("_n")


def _with_totals(df: DataFrame, part: str, totals: dict[str, Column]) -> DataFrame:
    """df with figures of each series, pre-aggregated and joined, so that a series needn't be in one task."""
    held = df.groupBy(F.col(part).alias("_part")).agg(*(v.alias(k) for k, v in totals.items()))
    return df.join(held, F.col(part).eqNullSafe(F.col("_part")))


def z_score(df: DataFrame, columns: list[str], part: str = "session", least: float = 1e-8) -> DataFrame:
    """Centred by the mean and scaled by the sample deviation; only centred where that is tiny."""
    names = df.columns
    totals = {f"_a_{c}": F.avg(c) for c in columns} | {f"_s_{c}": F.stddev_samp(c) for c in columns}
    scaled = [
        (
            (F.col(c) - F.col(f"_a_{c}"))
            / F.when(F.col(f"_s_{c}") < least, F.lit(1.0)).otherwise(F.coalesce(F.col(f"_s_{c}"), F.lit(1.0)))
        ).alias(f"{c}_z")
        for c in columns
    ]
    return _with_totals(df, part, totals).select(*names, *scaled)


def min_max(
    df: DataFrame, column: str, low: float, high: float, part: str = "session", floor: float = 1e-9
) -> DataFrame:
    """Scaled to [low, high] over the series."""
    both = _with_totals(df, part, {"_low": F.min(column), "_high": F.max(column)})
    share = (F.col(column) - F.col("_low")) / F.greatest(F.col("_high") - F.col("_low"), F.lit(floor))
    return both.select(*df.columns, (share * (high - low) + low).alias(f"{column}_n"))


def peak(df: DataFrame, column: str, part: str = "session", least: float = 1e-8) -> DataFrame:
    """Scaled to a largest size of 1, unless that is tiny."""
    both = _with_totals(df, part, {"_top": F.max(F.abs(F.col(column)))})
    scaled = F.when(F.col("_top") < least, F.col(column)).otherwise(F.col(column) / F.col("_top"))
    return both.select(*df.columns, scaled.alias(f"{column}_p"))


def _preceding(df: DataFrame, value: Column, name: str, part: str, order: list[str], block: float) -> DataFrame:
    """df with ``value`` of the row before in its series, null at the first: inside blocks of time, and from the last row of
    the block before, so that a long series isn't one task."""
    place = F.struct(*(F.col(c).alias(f"_o{k}") for k, c in enumerate(order)))
    cut = df.withColumn("_block", F.floor(F.col(order[0]) / block)).withColumn("_own", F.struct(value.alias("v")))
    cut = cut.withColumn("_prev", F.lag("_own").over(Window.partitionBy(part, "_block").orderBy(*order)))
    ends = cut.groupBy(part, "_block").agg(F.max_by("_own", place).alias("_high"))
    earlier = F.lag("_high").over(Window.partitionBy(part).orderBy("_block")).alias("_earlier")
    both = _of_blocks(cut, ends.select(part, "_block", earlier), part)
    return both.withColumn(name, F.coalesce("_prev", "_earlier")["v"]).drop("_block", "_own", "_prev", "_earlier")


def gaps(df: DataFrame, part: str = "session", t: str = "t", block: float = 86_400.0) -> DataFrame:
    """Median and largest time between neighbours of each series, null for one row."""
    d = _preceding(df.select(part, t).filter(F.col(t).isNotNull()), F.col(t), "_before", part, [t], block)
    d = d.withColumn("_d", F.col(t) - F.col("_before"))
    return d.groupBy(part).agg(F.median("_d").alias("median_gap"), F.max("_d").alias("max_gap"))


def geo_embedding(df: DataFrame, part: str = "session", fastest: float = 120.0) -> DataFrame:
    """``embedding`` of a fix: latitude and longitude in [-1, 1] and altitude in [0, 1] over its series, speed in [0, 1] up
    to ``fastest`` km/h, sine and cosine of the heading.  Missing altitude, speed and heading are 0."""
    for c in ("alt", "speed_kmh", "heading"):
        df = df.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0))
    for c, low in (("lat", -1.0), ("lon", -1.0), ("alt", 0.0)):
        df = min_max(df, c, low, 1.0, part)
    return df.withColumn(
        "embedding",
        F.array("lat_n", "lon_n", "alt_n", geo.speed_share(F.col("speed_kmh"), fastest), *geo.cyclic(F.col("heading"))),
    ).drop("lat_n", "lon_n", "alt_n")


def hysteresis(
    df: DataFrame, part: str = "session", i: str = "frame", m: str = "magnitude", high: float = 3.0, low: float = 1.0,
    block: int = 65_536,
) -> DataFrame:
    """Action segments: from above ``high`` to the first below ``low``.  The mean includes the closing frame; a series
    without any is one segment of confidence 0.5.  Needs low <= high.

    A series is worked through in blocks of ``block`` frames; a block is known by its last crossing.
    """
    if low > high:
        raise ValueError("low must not exceed high")
    cut = df.withColumn("_block", F.floor(F.col(i) / block)).withColumn(
        "_sign", F.when(F.col(m) > high, 1).when(F.col(m) < low, 0)
    )
    last = cut.groupBy(part, "_block").agg(F.max_by("_sign", F.when(F.col("_sign").isNotNull(), F.col(i))).alias("_last"))
    earlier = Window.partitionBy(part).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    entering = last.select(part, "_block", F.coalesce(F.last("_last", True).over(earlier), F.lit(0)).alias("_enters"))
    w = Window.partitionBy(part, "_block").orderBy(i)
    s = _of_blocks(cut, entering, part)
    on = F.coalesce(F.last("_sign", True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_enters")
    s = s.withColumn("_on", on)
    s = s.withColumn("_was", F.coalesce(F.lag("_on").over(w), "_enters"))
    s = s.withColumn("_starts", F.when((F.col("_on") == 1) & (F.col("_was") == 0), 1).otherwise(0))
    s = _running(s, "_starts", "_k", part, [i]).filter("_on = 1 or _was = 1")
    found = s.groupBy(part, "_k").agg(
        F.min(i).alias("start_frame"), F.max(F.when(F.col("_on") == 1, F.col(i))).alias("_last"),
        F.avg(m).alias("motion_magnitude"),
    )
    found = found.select(
        part, "start_frame", (F.col("_last") + 1).alias("end_frame"),
        F.least(F.lit(1.0), F.col("motion_magnitude") / (2 * high)).alias("confidence"), "motion_magnitude",
    )
    whole = df.groupBy(part).agg(
        F.lit(0).cast("long").alias("start_frame"), (F.max(i) + 1).alias("end_frame"), F.lit(0.5).alias("confidence"),
        F.avg(m).alias("motion_magnitude"),
    )
    return found.unionByName(whole.join(found.select(part).distinct(), part, "left_anti"))


def uniform(df: DataFrame, frames: int, part: str = "session", i: str = "frame", m: str = "magnitude") -> DataFrame:
    """Tumbling segments of ``frames`` frames, the last one short."""
    k = F.floor(F.col(i) / frames)
    return df.groupBy(part, k.alias("segment")).agg(
        F.min(i).alias("start_frame"), (F.max(i) + 1).alias("end_frame"), F.avg(m).alias("motion_magnitude")
    )


def deltas(
    df: DataFrame, columns: list[str], first: list[float], part: str = "session", t: str = "t", tie: str | None = None,
    block: float = 86_400.0,
) -> DataFrame:
    """Differences from the row before; the first row from given values.  Rows of one time are in the order of ``tie``,
    without it of the columns themselves."""
    order = [t, *([tie] if tie else columns)]
    near = _preceding(df, F.struct(*columns), "_before", part, order, block)
    return near.select(
        *df.columns, *(
            (F.col(c) - F.coalesce(F.col("_before")[c], F.lit(f))).alias(f"d_{c}") for c, f in zip(columns, first)
        )
    )


def train_share(
    df: DataFrame, order: list[str], share: float = 0.8, sample: int = 64, most: int = 1_000_000
) -> DataFrame:
    """split: the first max(1, int(n * share)) rows in order are train, the rest validation.

    Only the place of the cut is looked for: bounds drawn by hash divide the keys into ranges, whose counts (at most
    ``sample``) say which range holds the cut, and that range is divided again until it has ``most`` rows or one key.
    Rows outside are decided by comparing, those inside by numbering them in the ranges of the last division.  Of rows with one key at the cut
    any may be train.
    """
    names = [f"_o{k}" for k in range(len(order))]
    keyed = df.withColumn("_key", F.struct(*(F.col(c).alias(n) for c, n in zip(order, names))))
    kinds = {f.name: f.dataType for f in keyed.schema["_key"].dataType}
    bound = lambda b: F.struct(*(F.lit(b[n]).cast(kinds[n]).alias(n) for n in names))
    low, high, n = F.lit(True), F.lit(True), keyed.count()  # the range of the cut, its rows
    left = max(1, int(n * share))  # rows of it that are train
    before, after = F.lit(False), F.lit(False)
    while True:
        inside = keyed.filter(low & high).select("_key")
        drawn = inside.distinct().orderBy(F.xxhash64("_key"), "_key").limit(sample).orderBy("_key").collect()
        bounds = [bound(r["_key"]) for r in drawn]
        at = sum(((F.col("_key") >= b).cast("int") for b in bounds[1:]), F.lit(0))
        counts = dict(inside.groupBy(at.alias("_at")).count().collect())
        if n <= most or len(bounds) < 2:
            break
        here = 0
        while here < len(bounds) - 1 and left > counts.get(here, 0):
            left -= counts.get(here, 0)
            here += 1
        n = counts.get(here, 0)
        if here:
            low, before = F.col("_key") >= bounds[here], F.col("_key") < bounds[here]
        if here < len(bounds) - 1:
            high, after = F.col("_key") < bounds[here + 1], F.col("_key") >= bounds[here + 1]
    train = {}
    for r in range(max(1, len(bounds))):
        train[r] = min(left, counts.get(r, 0))
        left -= train[r]
    decided = keyed.filter(before | after).withColumn("split", F.when(before, "train").otherwise("val"))
    most_of = F.create_map(*(F.lit(x) for r, rows in train.items() for x in (r, rows)))[F.col("_at")]
    k = F.row_number().over(Window.partitionBy("_at").orderBy("_key"))
    close = keyed.filter(low & high).withColumn("_at", at).withColumn("split", F.when(k <= most_of, "train").otherwise("val"))
    return decided.unionByName(close.drop("_at")).drop("_key")


def segment_records(segments: DataFrame) -> DataFrame:
    """Segments as they are written: confidence and magnitude to 4 places."""
    return segments.withColumns(formats.rounded({"confidence": 4, "motion_magnitude": 4}))


def first_rows(df: DataFrame, order: list[str], k: int, part: str | None = None) -> DataFrame:
    """The first k rows in an order, of all or of each series."""
    if part is None:
        return df.orderBy(*order).limit(k)
    return df.withColumn(
        "_n", F.row_number().over(Window.partitionBy(part).orderBy(*order))
    ).filter(F.col("_n") <= k).drop("_n")
