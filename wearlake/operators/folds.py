"""Inherently sequential operators: ordered folds over series, as Arrow-batched functions."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.operators import series


Step = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def carried(
    df: DataFrame, columns: list[str], names: list[str], width: int, step: Step, part: str, t: str,
    tie: str | None = None,
) -> DataFrame:
    """Adds ``names``, a fold over each series in time order.

    ``step(state, values, fresh)`` gets (n, width) states, (n, 1 + columns) times and values of one row of each of n
    series and which rows are their series' first; it returns states and (n, names) results.  Rows are sorted in
    partitions and worked through a batch at a time, the series of a batch in lockstep; the last one's state is carried
    to the next batch, so that a series of any length needs no more memory.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, np.zeros(width)
        for p in parts:
            if not len(p):
                continue
            keys = p[part].astype(object).where(p[part].notna(), None).to_numpy()
            values = p[[t, *columns]].to_numpy(float)
            start = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
            size = np.diff(np.append(start, len(p)))
            order = np.argsort(-size, kind="stable")
            state, fresh = np.zeros((len(start), width)), np.ones(len(start), bool)
            if last is not None and last[0] == keys[0]:
                state[0], fresh[0] = held, False
            out = np.empty((len(p), len(names)))
            active = np.searchsorted(-size[order], -np.arange(size.max()), side="left")
            for k, n in enumerate(active.tolist()):
                own = order[:n]
                rows = start[own] + k
                state[own], out[rows] = step(state[own], values[rows], fresh[own] if k == 0 else np.zeros(n, bool))
            last, held = (keys[-1],), state[-1]
            p[names] = out
            yield p

    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"`{n}` double" for n in names])
    return df.repartition(part).sortWithinPartitions(part, t, *([tie] if tie else [])).mapInPandas(run, kinds)


def kalman(
    df: DataFrame, columns: list[str], part: str = "session", t: str = "t", start: float = 1e-4, drift: float = 1e-4,
    noise: float = 1e-2, tie: str | None = None,
) -> DataFrame:
    """Constant-velocity smoothing; the axes share one 2x2 covariance.  A step of no time counts as 1 s; one row stays."""
    m = len(columns)

    def step(state: np.ndarray, values: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        time, z = values[:, 0], values[:, 1:]
        before, x, v = state[:, 0], state[:, 1 : 1 + m], state[:, 1 + m : 1 + 2 * m]
        p00, p01, p11 = state[:, -3], state[:, -2], state[:, -1]
        dt = time - before
        dt = np.where(dt > 0, dt, 1.0)
        a = p00 + 2 * dt * p01 + dt * dt * p11 + drift * dt**4 / 4
        b = p01 + dt * p11 + drift * dt**3 / 2
        c = p11 + drift * dt * dt
        g, h = a / (a + noise), b / (a + noise)
        ahead = x + dt[:, None] * v
        e = z - ahead
        new = np.column_stack((time, ahead + g[:, None] * e, v + h[:, None] * e, (1 - g) * a, (1 - g) * b, c - h * b))
        if fresh.any():
            n = int(fresh.sum())
            new[fresh] = np.column_stack(
                (time[fresh], z[fresh], np.zeros((n, m)), np.full(n, start), np.zeros(n), np.full(n, start))
            )
        return new, new[:, 1 : 1 + m]

    return carried(df, columns, [f"{c}_smooth" for c in columns], 4 + 2 * m, step, part, t, tie)


def group_starts(p: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Where the groups of rows begin that lie together; nulls are equal."""
    k = p[keys].astype(object).where(p[keys].notna(), None).to_numpy()
    return np.concatenate(([0], np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1))


def whole_groups(parts: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches of a sorted partition, cut anew so that each holds whole groups only: small groups come many at a time."""
    held: list[pd.DataFrame] = []
    for p in parts:
        if not len(p):
            continue
        cut = group_starts(p, keys)[-1]
        if held and not cut and len(group_starts(pd.concat([held[-1].iloc[-1:], p.iloc[:1]]), keys)) == 1:
            held.append(p)
            continue
        done = [*held, p.iloc[:cut]] if cut else held
        if done:
            yield pd.concat(done, ignore_index=True)
        held = [p.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def merged(rows: list[tuple], least: int) -> list[tuple]:
    """Segments (start, end, confidence, magnitude) in order, short ones merged."""
    size = lambda r: r[1] - r[0]
    join = lambda a, b: (a[0], b[1], max(a[2], b[2]), (a[3] * size(a) + b[3] * size(b)) / (size(a) + size(b)))
    again = True
    while again:
        again, done, k = False, [], 0
        while k < len(rows):
            r, k = rows[k], k + 1
            if size(r) < least and k < len(rows):
                r, k, again = join(r, rows[k]), k + 1, True
            elif size(r) < least and done:
                r, again = join(done.pop(), r), True
            done.append(r)
        rows = done
    return rows


def merge_short(df: DataFrame, least: int = 15, part: str = "session") -> DataFrame:
    """Segments shorter than ``least`` frames join their next neighbour, else the one before, until none changes."""
    names = ["start_frame", "end_frame", "confidence", "motion_magnitude"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in whole_groups(parts, [part]):
            starts = group_starts(p, [part])
            rows = list(p[names].itertuples(index=False, name=None))
            made = [merged(rows[a:b], least) for a, b in zip(starts, [*starts[1:], len(p)])]
            out = pd.DataFrame([r for m in made for r in m], columns=names)
            out.insert(0, part, p[part].to_numpy()[np.repeat(starts, [len(m) for m in made])])
            yield out

    return df.select(part, *names).repartition(part).sortWithinPartitions(part, "start_frame").mapInPandas(
        run,
        f"`{part}` {df.schema[part].dataType.simpleString()}, start_frame long, end_frame long, confidence double, motion_magnitude double",
    )


def orientation(
    df: DataFrame, gyro: tuple[str, str, str] = ("gx", "gy", "gz"), dt: float = 0.01, part: str = "session",
    t: str = "t", tie: str | None = None,
) -> DataFrame:
    """Quaternion (qx, qy, qz, qw) integrated from angular rates, from identity; tiny turns are skipped."""

    def step(state: np.ndarray, values: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y, z, w = np.where(fresh[:, None], np.array([0.0, 0.0, 0.0, 1.0]), state).T
        rate = np.sqrt((values[:, 1:] ** 2).sum(axis=1))
        turned = rate * dt > 1e-10
        s = np.sin(rate * dt / 2) / np.where(turned, rate, 1.0)
        a, b, c, d = values[:, 1] * s, values[:, 2] * s, values[:, 3] * s, np.cos(rate * dt / 2)
        q = np.column_stack(
            (
                w * a + x * d + y * c - z * b, w * b - x * c + y * d + z * a, w * c + x * b - y * a + z * d,
                w * d - x * a - y * b - z * c,
            )
        )
        q /= np.sqrt((q**2).sum(axis=1))[:, None]
        out = np.where(turned[:, None], q, np.column_stack((x, y, z, w)))
        return out, out

    return carried(df, list(gyro), ["qx", "qy", "qz", "qw"], 4, step, part, t, tie)


class SecondOrder:
    """A recursive filter of second order whose state is two numbers, so that a block is an affine map of the state."""

    def __init__(self, b: np.ndarray, a: np.ndarray):
        self.b, self.a = b, a
        self.matrix = np.array([[-a[0], 1.0], [-a[1], 0.0]])
        self.gain = np.array([b[1] - a[0] * b[0], b[2] - a[1] * b[0]])

    def power(self, n: int) -> np.ndarray:
        """The linear part of the map of n samples."""
        return np.linalg.matrix_power(self.matrix, n)

    def run(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(outputs, state after); pieces of the samples go in lockstep from no state, then each gets its own."""
        n = len(x)
        size = max(1, math.isqrt(n))
        count = n // size
        pieces = x[: count * size].reshape(count, size)
        z, out = np.zeros((count, 2)), np.empty((count, size))
        for k in range(size):
            v = pieces[:, k]
            out[:, k] = self.b[0] * v + z[:, 0]
            z = z @ self.matrix.T + v[:, None] * self.gain
        through, answer = self.power(size), np.empty((size, 2))
        row = np.array([1.0, 0.0])
        for k in range(size):
            answer[k] = row
            row = row @ self.matrix
        starts = np.empty((count, 2))
        for k in range(count):
            starts[k] = state
            state = through @ state + z[k]
        made = [(out + starts @ answer.T).ravel()]
        rest = np.empty(n - count * size)
        for k, v in enumerate(x[count * size :]):
            rest[k] = self.b[0] * v + state[0]
            state = self.matrix @ state + v * self.gain
        return np.concatenate([*made, rest]), state


#: Samples by which a series is continued at both ends, turned round.
PAD = 9


def high_pass_filter(rate: float, cut: float = 0.5) -> tuple[SecondOrder, np.ndarray]:
    """A second-order Butterworth high-pass, and its state after a constant 1 for ever."""
    k = math.tan(math.pi * min(cut / (rate / 2), 0.99) / 2)
    n = 1 / (1 + math.sqrt(2) * k + k * k)
    b, a = np.array([n, -2 * n, n]), np.array([2 * (k * k - 1) * n, (1 - math.sqrt(2) * k + k * k) * n])
    return SecondOrder(b, a), np.array([-b[0], b[0]])


def high_pass(x: np.ndarray, rate: float, cut: float = 0.5) -> np.ndarray:
    """Zero-phase high-pass with odd extension by PAD samples; that many or fewer samples stay as they are."""
    if len(x) <= PAD:
        return x.copy()
    filt, still = high_pass_filter(rate, cut)
    wide = np.concatenate((2 * x[0] - x[PAD:0:-1], x, 2 * x[-1] - x[-2 : -PAD - 2 : -1]))
    once = lambda s: filt.run(s, still * s[0])[0]
    return once(once(wide)[::-1])[::-1][PAD:-PAD]


def high_pass_many(x: np.ndarray, sizes: np.ndarray, rate: float, cut: float = 0.5) -> np.ndarray:
    """``high_pass`` of series of more than PAD samples that follow each other, in lockstep."""
    filt, still = high_pass_filter(rate, cut)
    starts, who = np.cumsum(sizes) - sizes, np.arange(len(sizes))
    owner, place = np.repeat(who, sizes), np.arange(len(x)) - np.repeat(starts, sizes)
    total, last = sizes + 2 * PAD, starts + sizes - 1
    wide = np.zeros((int(total.max()), len(sizes)))
    wide[PAD + place, owner] = x
    for k in range(PAD):
        wide[k] = 2 * x[starts] - x[starts + PAD - k]
        wide[PAD + sizes + k, who] = 2 * x[last] - x[last - 1 - k]

    def once(v: np.ndarray) -> np.ndarray:
        out, (p, q) = np.empty_like(v), still[:, None] * v[0]
        for k, row in enumerate(v):
            out[k] = filt.b[0] * row + p
            p, q = filt.gain[0] * row - filt.a[0] * p + q, filt.gain[1] * row - filt.a[1] * p
        return out

    turned = lambda v: v[np.maximum(total - 1 - np.arange(len(v))[:, None], 0), who]
    return turned(once(turned(once(wide))))[PAD + place, owner]


#: Samples up to which series are filtered in lockstep, and the most numbers of such a block.
SHORT, LOCKSTEP = 1024, 1_000_000


def _high_passed(p: pd.DataFrame, starts: np.ndarray, columns: list[str], rate: float) -> pd.DataFrame:
    """Whole series in the order of time with <column>_hp; those of up to SHORT samples in blocks of about one length."""
    sizes = np.diff(np.append(starts, len(p)))
    order = np.argsort(sizes, kind="stable")
    few = order[(sizes[order] > PAD) & (sizes[order] <= SHORT)]
    each = max(1, LOCKSTEP // (SHORT + 2 * PAD))
    blocks = [few[k : k + each] for k in range(0, len(few), each)]
    new = {}
    for c in columns:
        x = p[c].to_numpy(float)
        out = x.copy()
        for block in blocks:
            n = sizes[block]
            at = np.repeat(starts[block] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out[at] = high_pass_many(x[at], n, rate)
        for k in order[sizes[order] > SHORT]:
            out[starts[k] : starts[k] + sizes[k]] = high_pass(x[starts[k] : starts[k] + sizes[k]], rate)
        new[f"{c}_hp"] = out
    return p.assign(**new)


def remove_gravity(
    df: DataFrame, columns: list[str], rate: float = 100.0, part: str = "session", t: str = "t", tie: str | None = None,
    size: int = 65_536, block: float = series.BLOCK_S,
) -> DataFrame:
    """Adds <column>_hp, each series' zero-phase high-pass in the order of time; nulls and NaN spread as they do in it.

    A series is cut into blocks of ``size`` samples (the last one up to twice that).  A block maps the filter's state
    to the state after it, an affine map; the maps are composed over one row a block, once forward and, over what the
    forward pass gives, once backward, so a series of any length is many tasks.  Series of one block, under twice
    ``size``, are filtered whole, many at a time.
    """
    filt, still = high_pass_filter(rate)
    counts = df.groupBy(F.col(part).alias("_part")).agg(F.count("*").alias("_rows"))
    of_length = lambda c: df.join(counts.filter(c), F.col(part).eqNullSafe(F.col("_part"))).select(*df.columns)
    own = series.placed(of_length(F.col("_rows") >= 2 * size), part, t, tie, block)
    key = [part, "_b"]
    own = own.withColumn("_b", F.least(F.floor(F.col("_i") / size), F.greatest(F.floor(F.col("_n") / size), F.lit(1)) - 1).cast("long"))
    kind = df.schema[part].dataType.simpleString()
    state = ", ".join(f"`s{k}` array<double>" for k in range(len(columns)))

    def widened(p: pd.DataFrame, c: str) -> np.ndarray:
        """A block's samples, with the continuation where it is the first or last of its series."""
        x, first, last = p[c].to_numpy(float), p["_i"].iloc[0] == 0, p["_i"].iloc[-1] == p["_n"].iloc[0] - 1
        head = 2 * x[0] - x[PAD:0:-1] if first else x[:0]
        tail = 2 * x[-1] - x[-2 : -PAD - 2 : -1] if last else x[:0]
        return np.concatenate((head, x, tail))

    def told(p: pd.DataFrame, maps: list[list[float]], count: int) -> pd.DataFrame:
        row = {part: p[part].iloc[0], "_b": p["_b"].iloc[0], "count": count} | {f"s{k}": m for k, m in enumerate(maps)}
        return pd.DataFrame([row])

    def forward(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("_i")
        maps = []
        for c in columns:
            x = widened(p, c)
            begin = still * x[0] if p["_i"].iloc[0] == 0 else np.zeros(2)
            maps.append(filt.run(x, begin)[1].tolist())
        return told(p, maps, len(x))

    def composed(blocks: DataFrame, backward: bool) -> DataFrame:
        """(part, _b, s...): the state that enters each block, from the states after blocks that began with none."""

        def run(p: pd.DataFrame) -> pd.DataFrame:
            p = p.sort_values("_b", ascending=not backward).reset_index(drop=True)
            entering = {f"s{k}": [] for k in range(len(columns))}
            for name, out in entering.items():
                z = np.zeros(2)
                for n, (m, count) in enumerate(zip(p[name], p["count"])):
                    out.append(z.tolist())
                    z = (filt.power(int(count)) @ z if n else 0.0) + np.asarray(m, float)
            return p[[part, "_b"]].assign(**entering)

        return blocks.groupBy(part).applyInPandas(run, f"`{part}` {kind}, _b long, {state}")

    def passed(p: pd.DataFrame, states: pd.DataFrame, c: int) -> np.ndarray:
        x = widened(p, columns[c])
        return filt.run(x, still * x[0] if p["_i"].iloc[0] == 0 else np.asarray(states[f"s{c}"].iloc[0], float))[0]

    def backward(p: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("_i")
        last, maps = p["_i"].iloc[-1] == p["_n"].iloc[0] - 1, []
        for c in range(len(columns)):
            y = passed(p, states, c)[::-1]
            maps.append(filt.run(y, still * y[0] if last else np.zeros(2))[1].tolist())
        return told(p, maps, len(y))

    def finished(p: pd.DataFrame, states: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("_i").reset_index(drop=True)
        last, head = p["_i"].iloc[-1] == p["_n"].iloc[0] - 1, PAD if p["_i"].iloc[0] == 0 else 0
        for c, name in enumerate(columns):
            y = passed(p, states, c)[::-1]
            out = filt.run(y, still * y[0] if last else np.asarray(back[f"s{c}"].iloc[0], float))[0][::-1]
            p[f"{name}_hp"] = out[head : head + len(p)]
        return p

    names = df.columns

    def filtered(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in whole_groups(parts, [part]):
            yield _high_passed(p, group_starts(p, [part]), columns, rate)

    # up to PAD samples stay; null and NaN are alike in both ways
    short = of_length(F.col("_rows") < 2 * size).repartition(part).sortWithinPartitions(part, t, *([tie] if tie else []))
    long = own
    narrow = long.select(*key, "_i", "_n", *columns)
    into = composed(narrow.groupBy(*key).applyInPandas(forward, f"`{part}` {kind}, _b long, count long, {state}"), False)
    ahead = narrow.groupBy(*key).cogroup(into.groupBy(*key)).applyInPandas(backward, f"`{part}` {kind}, _b long, count long, {state}")
    out = composed(ahead, True)
    both = into.join(out.select(*key, *(F.col(f"s{k}").alias(f"r{k}") for k in range(len(columns)))), key)
    whole = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"`{c}_hp` double" for c in columns])

    def close(p: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        back = states.rename(columns={f"r{k}": f"b{k}" for k in range(len(columns))})
        back = back[[f"b{k}" for k in range(len(columns))]].rename(columns={f"b{k}": f"s{k}" for k in range(len(columns))})
        return finished(p, states, back)[[*names, *(f"{c}_hp" for c in columns)]]

    done = long.select(*key, "_i", "_n", *(c for c in names if c != part)).groupBy(*key).cogroup(both.groupBy(*key)).applyInPandas(close, whole)
    return done.unionByName(short.mapInPandas(filtered, whole))


@functools.lru_cache(8)
def _taps(most: int, up: int) -> np.ndarray:
    k = np.arange(-10 * most, 10 * most + 1)
    taps = np.sinc(k / most) * np.kaiser(len(k), 5.0)
    return taps * (up / taps.sum())


def resample(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Polyphase rate change with a Kaiser (5) windowed sinc of 20 * max(up, down) + 1 taps; length ceil(n * up / down)."""
    d = math.gcd(rate, to)
    up, down = to // d, rate // d
    if up == down or not len(x):
        return np.asarray(x, float)
    most = max(up, down)
    taps = _taps(most, up)
    wide = np.zeros(len(x) * up)
    wide[::up] = x
    return np.convolve(wide, taps)[10 * most :][: len(wide)][::down][: -(-len(x) * up // down)]


def resample_audio(df: DataFrame, to: int, samples: str = "samples", rate: str = "rate") -> DataFrame:
    """Arrays of samples at a new rate."""

    @F.pandas_udf("array<double>")
    def run(x: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else resample(np.asarray(a, float), int(q), to) for a, q in zip(x, r)])

    return df.withColumn(samples, run(F.col(samples), F.col(rate))).withColumn(rate, F.lit(to))


def resample_blocks(
    blocks: DataFrame, to: int, part: str = "session", block: str = "block", samples: str = "samples", rate: str = "rate"
) -> DataFrame:
    """(part, block, first, samples, rate) at a new rate, ``first`` being the place of a block's first sample in its recording.

    A recording comes as blocks numbered from 0 of one length, the last one shorter, and needn't be in one task: a block
    gets what the filter reaches of its neighbours, and makes the samples whose times lie in it.  The blocks of a
    recording must be at least as long as the filter reaches (10 * max(up, down) / up samples), or be only one.
    """
    kind, number = (blocks.schema[c].dataType.simpleString() for c in (part, block))
    size = blocks.filter(F.col(block) == 0).select(F.col(part).alias("_p"), F.size(samples).cast("long").alias("_size"))
    known = blocks.join(size, F.col(part).eqNullSafe(F.col("_p"))).drop("_p")
    role = lambda k, shift, x: F.struct(F.lit(k).alias("role"), (F.col(block) + shift).alias("b"), x.alias("x"))
    reach = (F.ceil(10 * F.greatest(F.col(rate), F.lit(to)) / F.lit(to)) + 1).cast("int")
    # a block that isn't full is the last one, with nothing after it
    tail = F.when(F.size(samples) == F.col("_size"), F.slice(samples, F.greatest(F.size(samples) - reach + 1, F.lit(1)), reach))
    sent = known.withColumn("_s", F.explode(F.array(role(0, 0, F.col(samples)), role(1, 1, tail), role(2, -1, F.slice(samples, F.lit(1), reach)))))
    sent = sent.select(part, rate, "_size", "_s.*").filter("b >= 0 and (role <> 1 or x is not null)")

    def one(own: dict[int, np.ndarray], q: int, number_of: int, full: int) -> tuple[int, np.ndarray]:
        """Place of the first and the samples of a block, from itself and what is sent of its neighbours."""
        x, before, after = own[0], own.get(1, np.zeros(0)), own.get(2, np.zeros(0))
        d = math.gcd(q, to)
        up, down, start = to // d, q // d, number_of * full
        most = max(up, down)
        # the outputs whose places lie between this block's first sample and the next block's
        low, high = -(-start * up // down), -(-(start + len(x)) * up // down)
        if up == down:
            made = x
        else:
            taps = _taps(most, up)
            around, first = np.concatenate((before, x, after)), start - len(before)
            made = np.zeros(high - low)
            for at in range(0, high - low, 8192):
                place = np.arange(low + at, min(high, low + at + 8192)) * down
                near = -(-(place - 10 * most) // up)
                which = near[:, None] + np.arange(20 * most // up + 1)
                tap = place[:, None] - which * up + 10 * most
                inside = (tap >= 0) & (tap <= 20 * most) & (which >= first) & (which < first + len(around))
                values = around[np.clip(which - first, 0, len(around) - 1)] * taps[np.clip(tap, 0, 20 * most)]
                made[at : at + len(place)] = np.where(inside, values, 0.0).sum(axis=1)
        return low, made

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in whole_groups(parts, [part, "b"]):
            starts = group_starts(p, [part, "b"])
            roles, xs, rates, numbers, full = (p[c].to_numpy() for c in ("role", "x", rate, "b", "_size"))
            out = []
            for a, z in zip(starts, [*starts[1:], len(p)]):
                own = {int(r): np.asarray(x, float) for r, x in zip(roles[a:z], xs[a:z])}
                if 0 in own:  # else beyond the last block
                    out.append((a, *one(own, int(rates[a]), int(numbers[a]), int(full[a]))))
            at = [a for a, _, _ in out]
            yield pd.DataFrame({
                part: p[part].to_numpy()[at], block: numbers[at], "first": [low for _, low, _ in out],
                samples: pd.Series([made for _, _, made in out], dtype=object), rate: to,
            })

    return sent.repartition(part, "b").sortWithinPartitions(part, "b").mapInPandas(
        run, f"`{part}` {kind}, `{block}` {number}, first long, `{samples}` array<double>, `{rate}` int"
    )
