"""Motion between frames: sparse tracking of corners and dense displacement from quadratic fits.

Frames are raw bytes (``image`` with ``height``, ``width``, ``channels``, 8 bits, blue first), numbered from 0 in a
session.  Tracked corners are chosen anew every ``RENEW`` frames, so a session falls into blocks that share only
their border frame: a task holds RENEW + 1 frames, however long the session is.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.functions import text

# fixed values: corner choice, tracking and dense flow as usual for wearable video
RENEW, FEWEST = 10, 10
CORNERS, QUALITY, APART, AREA = 100, 0.3, 7, 7
WINDOW, LEVELS, ROUNDS, STEP = 15, 3, 10, 0.03
POLY, POLY_SIGMA, BOX, DENSE_LEVELS, DENSE_ROUNDS = 5, 1.2, 15, 3, 3
SAMPLED = 10
#: The least smaller eigenvalue a pixel of a window that can be tracked, in grey levels squared.
FLAT = 1e-4
#: Pixels of the frame pairs whose dense displacement is worked out together.
PIXELS = 1 << 16


def gray(raw: bytes | None, height: int, width: int, channels: int) -> np.ndarray | None:
    """Brightness as whole numbers in doubles; of one or two channels, the first.  None of an image without its bytes."""
    if raw is None or not len(raw) or len(raw) != height * width * channels:
        return None
    x = np.frombuffer(raw, np.uint8).reshape(height, width, channels).astype(np.float64)
    return np.rint(x[:, :, :3] @ np.array([0.114, 0.587, 0.299])) if channels >= 3 else x[:, :, 0]


@lru_cache(maxsize=64)
def _mirrored(n: int, reach: int) -> np.ndarray:
    """The places of a row that goes on mirrored at both ends without repeating them; a single place goes on."""
    return np.pad(np.arange(n), reach, mode="reflect" if n > 1 else "edge")


def along(x: np.ndarray, stencil: np.ndarray, axis: int) -> np.ndarray:
    """The correlation with an odd stencil along one axis, mirrored at the edges."""
    n, reach = x.shape[axis], len(stencil) // 2
    p = x.take(_mirrored(n, reach), axis)
    out = np.zeros(x.shape)
    for k, w in enumerate(stencil):
        if w:
            part = p[(..., slice(k, k + n)) + (slice(None),) * (-1 - axis)]
            out += part if w == 1 else w * part
    return out


def separable(x: np.ndarray, down: np.ndarray, across: np.ndarray) -> np.ndarray:
    """The correlation of images (their last two axes) with the product of two odd stencils."""
    return along(along(x, down, -2), across, -1)


def window_sums(x: np.ndarray, size: int, axis: int) -> np.ndarray:
    """Sums of ``size`` (odd) pixels in a row along one axis, mirrored at the edges, from sums of 1, 2, 4 ... pixels."""
    n = x.shape[axis]
    own = x.take(_mirrored(n, size // 2), axis)
    cut = lambda a, first, many: a[(..., slice(first, first + many)) + (slice(None),) * (-1 - axis)]
    out, at, width = np.zeros(x.shape), 0, 1
    while at < size:
        if (size - at) & width:
            out += cut(own, at, n)
            at += width
        if at < size:
            many = own.shape[axis] - width
            own, width = cut(own, 0, many) + cut(own, width, many), 2 * width
    return out


def gaussian(size: int, sigma: float) -> np.ndarray:
    at = np.arange(size) - size // 2
    g = np.exp(-(at**2) / (2 * sigma**2))
    return g / g.sum()


def gradients(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed central differences across and down, a grey level a pixel."""
    smooth, step = np.array([3.0, 10.0, 3.0]) / 16, np.array([-0.5, 0.0, 0.5])
    return separable(x, smooth, step), separable(x, step, smooth)


def sampled(x: np.ndarray, down: np.ndarray, across: np.ndarray) -> np.ndarray:
    """Bilinear values at places; beyond the edges, the edge's."""
    high, wide = x.shape
    down, across = np.clip(down, 0, high - 1), np.clip(across, 0, wide - 1)
    i, j = np.minimum(down.astype(int), max(high - 2, 0)), np.minimum(across.astype(int), max(wide - 2, 0))
    u, v = down - i, across - j
    flat, low, right = x.ravel(), wide if high > 1 else 0, 1 if wide > 1 else 0
    at = i * wide + j
    top = flat[at] * (1 - v) + flat[at + right] * v
    return top * (1 - u) + (flat[at + low] * (1 - v) + flat[at + low + right] * v) * u


def corners(x: np.ndarray) -> np.ndarray:
    """(row, column) of the best corners, best first: smaller eigenvalue of the structure tensor at least QUALITY of the
    largest, the largest of its 3 x 3, APART pixels from better ones; not on the edge."""
    gx, gy = gradients(x)
    box = np.ones(AREA)
    xx, yy, xy = (separable(p, box, box) for p in (gx * gx, gy * gy, gx * gy))
    value = (xx + yy - np.sqrt((xx - yy) ** 2 + 4 * xy * xy)) / 2
    value[[0, -1]] = value[:, [0, -1]] = 0
    best = value.max(initial=0)
    if best <= FLAT * AREA * AREA:
        return np.zeros((0, 2))
    peak = value
    for axis, n in enumerate(value.shape):
        around = peak.take(_mirrored(n, 1), axis)
        peak = np.max([around.take(np.arange(k, k + n), axis) for k in range(3)], axis=0)
    i, j = np.nonzero((value >= QUALITY * best) & (value == peak))
    order = np.lexsort((j, i, -value[i, j]))
    left = np.stack((i[order], j[order]), axis=1).astype(float)
    found = []
    while len(left) and len(found) < CORNERS:
        found.append(left[0])
        left = left[((left - left[0]) ** 2).sum(axis=1) >= APART**2]
    return np.array(found)


def pyramid(x: np.ndarray, levels: int = LEVELS) -> list[np.ndarray]:
    """The image and its halves, as long as a window fits in."""
    out, five = [x], np.array([1.0, 4.0, 6.0, 4.0, 1.0]) / 16
    while len(out) < levels and min(out[-1].shape) // 2 >= WINDOW:
        out.append(separable(out[-1], five, five)[::2, ::2])
    return out


def track(before: list[np.ndarray], after: list[np.ndarray], points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where points of one pyramid are in the next, by least squares over windows from coarse to fine: (points, whether found).

    A point is lost if its window is flat or it leaves the picture.
    """
    side = np.arange(WINDOW) - WINDOW // 2
    dy, dx = (o.ravel()[None, :] for o in np.meshgrid(side, side, indexing="ij"))
    moved, steep = np.zeros_like(points), np.ones(len(points), bool)
    for level in range(len(before) - 1, -1, -1):
        first, second = before[level], after[level]
        at = points / 2**level
        y, x = at[:, :1] + dy, at[:, 1:] + dx
        gx, gy = gradients(first)
        patch, ix, iy = sampled(first, y, x), sampled(gx, y, x), sampled(gy, y, x)
        xx, yy, xy = (ix * ix).sum(1), (iy * iy).sum(1), (ix * iy).sum(1)
        steep = (xx + yy - np.sqrt((xx - yy) ** 2 + 4 * xy * xy)) / 2 > FLAT * WINDOW * WINDOW
        det = np.where(steep, xx * yy - xy * xy, 1.0)
        going = np.flatnonzero(steep)
        for _ in range(ROUNDS):
            if not len(going):
                break
            off = patch[going] - sampled(second, y[going] + moved[going, :1], x[going] + moved[going, 1:])
            bx, by = (off * ix[going]).sum(1), (off * iy[going]).sum(1)
            step = np.stack((xx[going] * by - xy[going] * bx, yy[going] * bx - xy[going] * by), axis=1) / det[going, None]
            moved[going] += step
            going = going[(step**2).sum(axis=1) > STEP**2]
        if level:
            moved *= 2
    to = points + moved
    high, wide = before[0].shape
    inside = (to[:, 0] >= 0) & (to[:, 0] <= high - 1) & (to[:, 1] >= 0) & (to[:, 1] <= wide - 1)
    return to, steep & inside


def block_magnitudes(frames: list[np.ndarray]) -> list[float]:
    """The mean displacement of the corners found again, for each frame after the first; 0 where none is.

    Corners are those of the first frame and, where fewer than FEWEST are left, of the frame reached.
    """
    out, points, before = [], corners(frames[0]), pyramid(frames[0])
    for x in frames[1:]:
        after, mean = pyramid(x), 0.0
        kept = np.zeros((0, 2))
        if len(points) and x.shape == before[0].shape:
            to, found = track(before, after, points)
            kept = to[found]
            if found.any():
                mean = float(np.sqrt(((kept - points[found]) ** 2).sum(axis=1)).mean())
        points = corners(x) if len(points) < FEWEST else kept
        out.append(mean)
        before = after
    return out


def _tasks(frames: DataFrame) -> int:
    """Into how many tasks groups of frames go: small as their bytes may be, their computation isn't, so they are never
    put together by their bytes."""
    return int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def magnitudes(frames: DataFrame, part: str = "session", i: str = "frame") -> DataFrame:
    """(session, frame, magnitude) of every frame; 0 for a session's first one.

    Frames are numbered from 0 without holes; after a hole tracking starts anew, with 0, as it does after a null image
    or one of another size.  Of several rows with one number one counts, the first by its bytes.
    """
    kind = {c: frames.schema[c].dataType.simpleString() for c in (part, i)}
    own = F.floor(F.col(i) / RENEW).cast("long")
    border = (F.col(i) % RENEW == 0) & (F.col(i) > 0)
    blocks = frames.select(
        part, i, "image", "height", "width", "channels",
        F.explode(F.when(border, F.array(own, own - 1)).otherwise(F.array(own))).alias("_block"),
    )

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values([i, "image"], na_position="last").drop_duplicates(i)
        made, run_of, last = {}, [], None
        number = p[i].tolist()

        def close() -> None:
            if run_of:
                made.update(zip(run_of[1:], block_magnitudes([pictures[k] for k in run_of])))

        shots = ((k, gray(*r)) for k, r in zip(number, p[["image", "height", "width", "channels"]].itertuples(index=False)))
        pictures = {k: x for k, x in shots if x is not None}
        for k in number:
            if k not in pictures or last is None or k != last + 1 or pictures[k].shape != pictures[last].shape:
                close()
                run_of = []
            if k in pictures:
                run_of.append(k)
            last = k if k in pictures else None
        close()
        start = int(p["_block"].iloc[0]) * RENEW
        mine = [k for k in number if k != start or start == 0]  # the border frame belongs to the block before
        out = pd.DataFrame({i: mine, "magnitude": [made.get(k, 0.0) for k in mine]})
        out.insert(0, part, p[part].iloc[0])
        return out

    spread = blocks.repartition(_tasks(frames), part, "_block")
    return spread.groupBy(part, "_block").applyInPandas(run, f"`{part}` {kind[part]}, `{i}` {kind[i]}, magnitude double")


def quadratic(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bx, by, axx, ayy, axy) of the fit x' A x + b' x + c around each pixel of images, weighed by a Gaussian.

    The moments come from separable stencils, the coefficients from one 6 x 6 system for all pixels.
    """
    at = np.arange(POLY) - POLY // 2
    g = gaussian(POLY, POLY_SIGMA)
    powers = [g, g * at, g * at * at]
    y, xx = (o.ravel() for o in np.meshgrid(at, at, indexing="ij"))
    basis = np.stack((np.ones(y.size), xx, y, xx * xx, y * y, xx * y), axis=1)
    solve = np.linalg.inv(basis.T @ (basis * np.outer(g, g).ravel()[:, None]))
    rows = [along(x, p, -2) for p in powers]
    moments = np.stack([along(rows[d], powers[a], -1) for a, d in ((0, 0), (1, 0), (0, 1), (2, 0), (0, 2), (1, 1))])
    c = np.tensordot(solve, moments, 1)
    return c[1], c[2], c[3], c[4], c[5] / 2


def resized(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resampling of an image (with channels or not) between pixel centres, as doubles."""
    down, across = (_resampling(n, m) for n, m in ((x.shape[0], height), (x.shape[1], width)))
    return np.einsum("ah,hw...,bw->ab...", down, x.astype(np.float64), across, optimize=True)


def _resampling(n: int, m: int) -> np.ndarray:
    at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
    low = np.minimum(at.astype(int), max(n - 2, 0))
    out = np.zeros((m, n))
    out[np.arange(m), low] = 1 - (at - low)
    if n > 1:
        out[np.arange(m), low + 1] += at - low
    return out


def _scaled(x: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """Images one after another, each as ``resized`` does."""
    return _resampling(x.shape[1], size[0]) @ x @ _resampling(x.shape[2], size[1]).T


def _displaced(fields: list[np.ndarray], down: np.ndarray, across: np.ndarray) -> list[np.ndarray]:
    """Each field (images one after another) as ``sampled`` gives it at every pixel's place plus its displacement."""
    high, wide = down.shape[1:]
    down = np.clip(down + np.arange(high, dtype=float)[:, None], 0, high - 1)
    across = np.clip(across + np.arange(wide, dtype=float), 0, wide - 1)
    i, j = np.minimum(down.astype(int), max(high - 2, 0)), np.minimum(across.astype(int), max(wide - 2, 0))
    u, v = down - i, across - j
    low, right = wide if high > 1 else 0, 1 if wide > 1 else 0
    at = (np.arange(len(down))[:, None, None] * high + i) * wide + j
    places, rest = (at, at + right, at + low, at + low + right), (1 - u, 1 - v)
    out = []
    for t in fields:
        a, b, c, d = (t.take(k) for k in places)
        out.append((a * rest[1] + b * v) * rest[0] + (c * rest[1] + d * v) * u)
    return out


def displacements(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(down, across) of every pixel of each of n images to the next one, n - 1 of them, from the quadratic fits of the
    images, coarse to fine.  A fit is made once an image, and all pairs are worked through together."""
    high, wide = x.shape[1:]
    down = across = None
    for level in range(DENSE_LEVELS - 1, -1, -1):
        size = (round(high / 2**level), round(wide / 2**level))
        if level and min(size) < 2 * POLY:
            continue
        if level:
            sigma = (2**level - 1) / 2
            g = gaussian(2 * round(2.5 * sigma) + 1, sigma)
            own = _scaled(separable(x, g, g), size)
        else:
            own = x
        if down is None:
            down, across = (np.zeros((len(x) - 1, *size)) for _ in range(2))
        else:
            down, across = (_scaled(d, size) * n / d.shape[k + 1] for k, (d, n) in enumerate(zip((down, across), size)))
        fits = quadratic(own)
        one, two = [t[:-1] for t in fits], [t[1:] for t in fits]
        for _ in range(DENSE_ROUNDS):
            bx, by, axx, ayy, axy = _displaced(two, down, across)
            axx, ayy, axy = (one[2] + axx) / 2, (one[3] + ayy) / 2, (one[4] + axy) / 2
            hx = (one[0] - bx) / 2 + axx * across + axy * down
            hy = (one[1] - by) / 2 + axy * across + ayy * down
            xx, yy, xy = axx * axx + axy * axy, ayy * ayy + axy * axy, axy * (axx + ayy)
            rx, ry = axx * hx + axy * hy, axy * hx + ayy * hy
            sums = (window_sums(window_sums(t, BOX, -2), BOX, -1) / BOX**2 for t in (xx, yy, xy, rx, ry))
            xx, yy, xy, rx, ry = sums
            det = xx * yy - xy * xy + 1e-3
            across, down = (yy * rx - xy * ry) / det, (xx * ry - xy * rx) / det
    return down, across


def dense(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(down, across): the displacement of every pixel between two images."""
    down, across = displacements(np.stack((first, second)))
    return down[0], across[0]


def dense_magnitude(pictures: list[np.ndarray]) -> float:
    """The mean length of the dense displacement over the pairs of images of one size, PIXELS at a time or one pair."""
    pairs = max(1, PIXELS // max(1, pictures[0].size))
    means = []
    for a in range(0, len(pictures) - 1, pairs):
        means += np.hypot(*displacements(np.stack(pictures[a : a + pairs + 1]))).mean(axis=(1, 2)).tolist()
    return float(np.mean(means))


def segment_motion(segments: DataFrame, frames: DataFrame, part: str = "session", i: str = "frame") -> DataFrame:
    """segments (session, start_frame, end_frame, ...) with flow_magnitude, motion_level and motion_confidence.

    The magnitude is the mean length of the dense displacement over the pairs of the segment's first SAMPLED frames, so
    a task holds that many frames.  A segment of fewer than two frames is low with 0.4; one with a frame that is
    missing, null or of another size is low with 0.3, as one whose flow can't be had.
    """
    keys = [part, "start_frame", "end_frame"]
    last = F.least(F.col("end_frame"), F.col("start_frame") + SAMPLED)
    asked = segments.select(*keys).distinct()
    wanted = asked.withColumn(i, F.explode(F.sequence(F.col("start_frame"), F.greatest(last - 1, F.col("start_frame")))))
    held = wanted.join(frames.select(part, i, "image", "height", "width", "channels"), [part, i])

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values([i, "image"], na_position="last").drop_duplicates(i)
        first, end = int(p["start_frame"].iloc[0]), int(p["end_frame"].iloc[0])
        pictures = [gray(*r) for r in p[["image", "height", "width", "channels"]].itertuples(index=False)]
        whole = len(p) == min(end, first + SAMPLED) - first and all(x is not None for x in pictures)
        mean = None
        if whole and len(p) > 1:
            if len({x.shape for x in pictures}) == 1:
                mean = dense_magnitude(pictures)
        return p[keys].iloc[:1].assign(flow_magnitude=pd.Series([mean], index=p.index[:1], dtype=float))

    kinds = ", ".join(f"`{c}` {asked.schema[c].dataType.simpleString()}" for c in keys)
    found = held.repartition(_tasks(frames), *keys).groupBy(*keys).applyInPandas(run, f"{kinds}, flow_magnitude double")
    out = segments.join(found, keys, "left").withColumn("flow_magnitude", F.nanvl("flow_magnitude", F.lit(None).cast("double")))
    level, sure = text.motion_level(F.col("flow_magnitude"), F.col("end_frame") - F.col("start_frame"))
    return out.withColumn("motion_level", level).withColumn("motion_confidence", sure)
