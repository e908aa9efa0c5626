"""Names, numbers and schedules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SESSION_NAME = r"^[a-zA-Z0-9][a-zA-Z0-9\-_]{1,127}$"
UUID_NAME = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def fixed(x: Column, digits: int) -> Column:
    """Text with ``digits`` decimals, rounded on the exact binary value and half to even as C does; below 2**53 / 10**digits.

    The product with 10**digits is exact as a sum of two doubles, so a decimal tie is decided by the part that the
    rounded product lacks.
    """
    x, scale = x.cast("double"), float(10**digits)
    product = x * scale
    head = x * 134217729.0 - (x * 134217729.0 - x)  # the upper half of the bits
    lack = (head * scale - product) + (x - head) * scale
    whole = F.rint(product)
    tie = F.abs(product - whole) == 0.5
    whole = F.when(tie & (lack > 0), F.ceil(product).cast("double")).when(
        tie & (lack < 0), F.floor(product).cast("double")
    ).otherwise(whole)
    n = F.abs(whole).cast("long")
    sign = F.when(x < 0, "-").otherwise("")
    parts = [sign, F.floor(n / F.lit(10**digits)).cast("long").cast("string") if digits else n.cast("string")]
    return F.concat(
        *parts, F.lit("."), F.lpad((n % 10**digits).cast("string"), digits, "0")
    ) if digits else F.concat(*parts)


def session_name_ok(name: Column) -> Column:
    """A session name of 2 to 128 letters, digits, - and _ that begins with a letter or digit, or a UUID; null: no."""
    return F.coalesce(name.rlike(SESSION_NAME) | name.rlike(UUID_NAME), F.lit(False))


def episode_index(stem: Column) -> Column:
    """The number after the last _ of a file's stem, else -1."""
    return F.coalesce(F.element_at(F.split(stem, "_"), -1).try_cast("bigint"), F.lit(-1))


def clock(seconds: Column) -> Column:
    """mm:ss of whole seconds."""
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    minutes = F.floor(seconds / 60).cast("long")
    return F.concat(
        F.when(minutes < 100, two(minutes)).otherwise(minutes.cast("string")), F.lit(":"),
        two((seconds % 60).cast("long")),
    )


def path_time(ts: Column) -> Column:
    """A time in a folder name: year-month-day-hourminute."""
    return F.date_format(ts, "yyyy-MM-dd-HHmm")


def confidence(n_tokens: Column, avg_logprob: Column) -> Column:
    """0.5 without tokens, else e to the mean log-probability (-0.5 if missing), in [0, 1]."""
    return F.when(F.coalesce(n_tokens, F.lit(0)) == 0, 0.5).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.exp(F.coalesce(avg_logprob, F.lit(-0.5)))))
    )


def learning_rate(step: Column, steps: int, top: float = 3e-4, warm_up: int = 500, least: float = 1e-6) -> Column:
    """The rate that step ``step`` (from 0) leaves: linear up to ``top`` over ``warm_up`` steps, then down half a cosine
    whose period is ``steps``."""
    turn = F.pi() * (step - warm_up + 1) / max(1, steps)
    return F.when(
        step < warm_up, F.lit(top) * (step + 1) / max(1, warm_up)
    ).otherwise(least + F.lit((top - least) / 2) * (1 + F.cos(turn)))


def data_url(jpeg: Column) -> Column:
    """An encoded image as a data URL."""
    return F.concat(F.lit("data:image/jpeg;base64,"), F.base64(jpeg))


def rounded(places: dict[str, int]) -> dict[str, Column]:
    """Columns rounded half to even, for withColumns."""
    return {c: F.bround(F.col(c), n) for c, n in places.items()}
