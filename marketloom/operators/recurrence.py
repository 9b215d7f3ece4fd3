"""First-order linear recurrences y[t] = a * y[t-1] + u[t] along chunked series.

Inside a chunk the solution is a running sum, y[k] = a^k * (a * carry + sum(u[j] * a^-j)), so
it needs only a window function. The carry into a chunk is the last value of the chunk before
it: a weighted sum per chunk (a partial aggregation), combined over the earlier chunks whose
weight a^(rows) has not vanished in double precision.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketloom.operators.series import CHUNK, POS, chunk_window

_VANISHED = 1e-40
_MAX_SCALE_LOG10 = 280.0
_MAX_DEPTH = 8
_MAX_LEVEL_ROWS = 1024


def linear_recurrence(
    df: DataFrame, keys: list[str], outputs: dict[str, tuple[Column, float]], chunk_rows: int
) -> DataFrame:
    """Add one column per output, given as (input column u, factor 0 < a < 1).

    ``df`` carries positions and chunks of ``chunk_rows`` rows without halo rows.
    """
    for name, (_, a) in outputs.items():
        if not 0.0 < a < 1.0:
            raise ValueError(f"{name}: the factor must lie between 0 and 1")
        if -math.log10(a) * chunk_rows > _MAX_SCALE_LOG10:
            raise ValueError(f"{name}: chunks of {chunk_rows} rows overflow a^-rows; use shorter ones")
    step = (F.col(POS) - F.col(CHUNK) * chunk_rows).cast("double")
    inputs = df.withColumns({f"_u_{o}": u for o, (u, _) in outputs.items()})

    ends = inputs.groupBy(*keys, CHUNK).agg(
        *[
            F.sum(F.col(f"_u_{o}") * F.pow(F.lit(a), F.lit(chunk_rows - 1.0) - step)).alias(f"_end_{o}")
            for o, (_, a) in outputs.items()
        ]
    )
    carries = _carries(ends, keys, {o: a**chunk_rows for o, (_, a) in outputs.items()})
    running = Window.partitionBy(*keys, CHUNK).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    solved = {
        o: F.pow(F.lit(a), step)
        * (F.lit(a) * F.coalesce(f"_c_{o}", F.lit(0.0)) + F.sum(F.col(f"_u_{o}") * F.pow(F.lit(1.0 / a), step)).over(running))
        for o, (_, a) in outputs.items()
    }
    return (
        inputs.join(carries, [*keys, CHUNK], "left")
        .withColumns(solved)
        .drop(*[f"_u_{o}" for o in outputs], *[f"_c_{o}" for o in outputs])
    )


def halo_rows(a: float, tolerance: float = 1e-20) -> int:
    """Rows after which a start value has lost its weight in double precision."""
    return math.ceil(math.log(tolerance) / math.log(a))


def recurrence_over_halo(
    outputs: dict[str, tuple[Column, float]], keys: list[str], chunk_rows: int, halo: int, after: int = 0
) -> dict[str, Column]:
    """The recurrences as window columns over chunks whose halo is long enough to need no carry.

    With at least :func:`halo_rows` rows of the previous chunk in front, what lies before them
    weighs less than the rounding of a double, so one window pass solves the recurrence. Rows of
    the halo itself hold unfinished values and are to be dropped.
    """
    span = chunk_rows + halo + after
    for name, (_, a) in outputs.items():
        if halo < halo_rows(a):
            raise ValueError(f"{name}: the halo needs {halo_rows(a)} rows")
        if -math.log10(a) * span > _MAX_SCALE_LOG10:
            raise ValueError(f"{name}: groups of {span} rows overflow a^-rows; use shorter chunks")
    step = (F.col(POS) - F.col(CHUNK) * chunk_rows + halo).cast("double")
    running = chunk_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    return {
        o: F.pow(F.lit(a), step) * F.sum(u * F.pow(F.lit(1.0 / a), step)).over(running)
        for o, (u, a) in outputs.items()
    }


def _carries(ends: DataFrame, keys: list[str], weights: dict[str, float]) -> DataFrame:
    """The value before each chunk, from the chunk ends and the weight a^rows of a whole chunk.

    Where that weight vanishes within a few chunks, the few ends are added up. A slower one is a
    recurrence over the chunk ends themselves and is solved the same way, one level up.
    """
    quick = {o: w for o, w in weights.items() if _depth(w) <= _MAX_DEPTH}
    slow = {o: w for o, w in weights.items() if o not in quick}
    by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
    carries = ends.select(
        *keys, CHUNK, *[_weighted_ends(F.col(f"_end_{o}"), w, by_chunk).alias(f"_c_{o}") for o, w in quick.items()]
    )
    if not slow:
        return carries
    rows = min(_MAX_LEVEL_ROWS, *[int(_MAX_SCALE_LOG10 / -math.log10(w)) for w in slow.values()])
    level = ends.select(*keys, F.col(CHUNK).alias(POS), *[f"_end_{o}" for o in slow])
    level = level.withColumn(CHUNK, F.floor(F.col(POS) / rows))
    solved = linear_recurrence(level, keys, {f"_y_{o}": (F.col(f"_end_{o}"), w) for o, w in slow.items()}, rows)
    shifted = solved.select(
        *keys, (F.col(POS) + 1).alias(CHUNK), *[F.col(f"_y_{o}").alias(f"_c_{o}") for o in slow]
    )
    return carries.join(shifted, [*keys, CHUNK], "left")


def _depth(weight: float) -> int:
    """Chunks until a carry has vanished."""
    return 1 if weight <= 0.0 else 1 + math.ceil(math.log(_VANISHED) / math.log(weight))


def _weighted_ends(end: Column, weight: float, by_chunk: WindowSpec) -> Column:
    return sum(
        (F.lit(weight**back) * F.coalesce(F.lag(end, back + 1).over(by_chunk), F.lit(0.0)) for back in range(1, _depth(weight))),
        F.coalesce(F.lag(end, 1).over(by_chunk), F.lit(0.0)),
    )


def ema_input(x: Column, span: int) -> tuple[Column, float]:
    """Recurrence input and factor of an exponential mean seeded with the first value."""
    alpha = 2.0 / (span + 1)
    return F.when(F.col(POS) == 0, x).otherwise(F.lit(alpha) * x), 1.0 - alpha


def wilder_input(x: Column, period: int) -> tuple[Column, float]:
    """Wilder smoothing: the mean of rows 1..period at row ``period``, then x/period with factor 1 - 1/period.

    The starting mean needs no window of its own: rows up to ``period`` enter with the weight
    that the recurrence takes off again by then.
    """
    a = (period - 1.0) / period
    pos = F.col(POS)
    early = F.pow(F.lit(a), (pos - period).cast("double")) * x
    u = F.when(pos == 0, F.lit(0.0)).when(pos <= period, early).otherwise(x) / F.lit(float(period))
    return u, a


def ema_of_difference(
    x: Column, fast: int, slow: int, span: int
) -> tuple[tuple[Column, float], float, float]:
    """Terms of the EMA (``span``) of EMA(fast) - EMA(slow), from a recurrence over x itself.

    Two filters in a row split into partial fractions: the result is
    ``A_fast * EMA(fast) - A_slow * EMA(slow) + R`` with one more first-order recurrence R, so
    the nested mean needs no second pass. Returns R's input and factor, A_fast and A_slow. The
    difference is 0 in the first row, so the outer mean starts at 0.
    """
    outer_alpha, s = 2.0 / (span + 1), 1.0 - 2.0 / (span + 1)
    terms = []
    for inner in (fast, slow):
        u, a = ema_input(x, inner)
        if math.isclose(a, s):
            raise ValueError("the outer span must differ from both inner spans")
        terms.append((u, outer_alpha * a / (a - s), -outer_alpha * s / (a - s)))
    (u_f, a_f, b_f), (u_s, a_s, b_s) = terms
    return (F.lit(b_f) * u_f - F.lit(b_s) * u_s, s), a_f, a_s
