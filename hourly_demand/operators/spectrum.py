"""Periodogram of hourly series."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TS
from ..functions.time import hour_index
from ..sources.shared import checkpoint_root
from .groups import attach
from .windows import interpolate_linear


def detrend(filled: DataFrame, keys: Sequence[str] = (), value: str = "filled") -> DataFrame:
    """Position `j` in the series, its length `size`, and the residual `d` of a straight line."""
    hour = hour_index(TS)
    line = filled.groupBy(*keys).agg(
        F.min(hour).alias("_first"),
        F.count("*").alias("size"),
        F.regr_slope(value, hour.cast("double")).alias("_slope"),
        F.avg(value).alias("_level"),
        F.avg(hour.cast("double")).alias("_middle"),
    )
    residual = F.col(value) - F.col("_level") - F.col("_slope") * (hour - F.col("_middle"))
    return attach(filled, line, keys).select(
        *keys, (hour - F.col("_first")).cast("bigint").alias("j"), "size", residual.alias("d")
    )


#: A length without a divisor near its root takes the chirp, once the plain transform costs more by this factor.
DETOUR = 1.0


def _factors(size: Column) -> Column:
    """Struct of a and b with a x b = size, a the largest divisor up to the root."""
    root = F.floor(F.sqrt(size)).cast("int")
    divisors = F.filter(F.sequence(F.lit(1), root), lambda x: size % x == 0)
    a = F.array_max(divisors).cast("bigint")
    return F.struct(a.alias("a"), F.floor(size / a).alias("b"))


def _room(size: Column) -> Column:
    """Struct of a and b, nearly equal, with a x b >= 2 size - 1: the length of a convolution without overlap."""
    a = F.ceil(F.sqrt(2 * size - 1))
    return F.struct(a.alias("a"), F.ceil((2 * size - 1) / a).alias("b"))


def _turned(re: Column, im: Column, angle: Column) -> tuple[Column, Column]:
    """re + i im, turned by an angle."""
    return re * F.cos(angle) - im * F.sin(angle), re * F.sin(angle) + im * F.cos(angle)


def _transform(rows: DataFrame, by: Sequence[str], wanted: Column | None = None) -> DataFrame:
    """Discrete Fourier transform of length a x b of rows (by, a, b, j, re, im): by, a, b, k, re, im.

    Sums over a positions, a rotation, then sums over b: each step is a keyed partial aggregation, so
    the work is length x (a + b) instead of length x length and no series sits in one task. Positions
    without a row are zero. `wanted` filters k.
    """
    turn, length = F.lit(-2 * math.pi), F.col("a") * F.col("b")
    inner_angle = turn * ((F.col("j1") * F.col("k1")) % F.col("a")) / F.col("a")
    one, two = _turned(F.col("re"), F.col("im"), inner_angle)
    inner = (
        rows.withColumns({"j1": F.expr("j div b"), "j2": F.expr("j % b")})
        .withColumn("k1", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("a") - 1)))
        .groupBy(*by, "a", "b", "j2", "k1")
        .agg(F.sum(one).alias("re"), F.sum(two).alias("im"))
    )
    # The rotation and the outer term share one angle per target k.
    outer = inner.withColumn("k2", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("b") - 1)))
    outer = outer.withColumn("k", F.col("k1") + F.col("a") * F.col("k2"))
    if wanted is not None:
        outer = outer.filter(wanted)
    one, two = _turned(F.col("re"), F.col("im"), turn * ((F.col("j2") * F.col("k")) % length) / length)
    return outer.groupBy(*by, "a", "b", "k").agg(F.sum(one).alias("re"), F.sum(two).alias("im"))


def _chirp(place: Column) -> Column:
    """Angle pi place^2 / size, from a product that is reduced first."""
    return F.lit(math.pi) * ((place * place) % (2 * F.col("size"))) / F.col("size")


def _by_chirp(d: DataFrame, keys: Sequence[str], wanted: Column) -> DataFrame:
    """The transform at any length as a convolution with a chirp, at a length that splits evenly.

    j k = (j^2 + k^2 - (k - j)^2) / 2 turns the transform of a length into a convolution, which three
    transforms of a x b >= 2 size - 1 make: same frequencies, work (a x b) x (a + b) for primes too.
    The chirp depends on the length only; it is made and transformed once per length.
    """
    by = [*keys, "size"]
    long = d.withColumn("_room", _room(F.col("size"))).select(*by, "j", "d", "_room.a", "_room.b")
    turned = _turned(F.col("d"), F.lit(0.0), -_chirp(F.col("j")))
    signal = _transform(long.select(*by, "a", "b", "j", turned[0].alias("re"), turned[1].alias("im")), by)
    lengths = long.select("size", "a", "b").distinct()
    places = lengths.withColumn("j", F.explode(F.sequence(1 - F.col("size"), F.col("size") - 1)))
    chirp = places.select(
        "size", "a", "b", F.pmod(F.col("j"), F.col("a") * F.col("b")).alias("j"), F.cos(_chirp(F.col("j"))).alias("re"), F.sin(_chirp(F.col("j"))).alias("im")
    )
    filtered = _transform(chirp, ["size"]).withColumnsRenamed({"re": "c_re", "im": "c_im"})
    re = F.col("re") * F.col("c_re") - F.col("im") * F.col("c_im")
    im = F.col("re") * F.col("c_im") + F.col("im") * F.col("c_re")
    # The inverse transform is the transform of the conjugate, conjugated.
    product = signal.join(filtered, ["size", "a", "b", "k"]).select(*by, "a", "b", F.col("k").alias("j"), re.alias("re"), (-im).alias("im"))
    back = _transform(product, by, wanted)
    length = F.col("a") * F.col("b")
    one, two = _turned(F.col("re") / length, -F.col("im") / length, -_chirp(F.col("k")))
    return back.select(*by, "k", one.alias("re"), two.alias("im"))


def periodogram(
    panel: DataFrame, keys: Sequence[str] = (), shortest: float = 2.0, longest: float = 400.0
) -> DataFrame:
    """Power of each frequency k / size whose period lies in [shortest, longest] hours.

    NULL targets are interpolated for this purpose only, and a straight line is removed. Lengths that
    split into a x b with a near the root are transformed as they are; others, primes for one, by a
    chirp at a longer length that does. No more than length x (a + b) terms are summed in either way.
    """
    checkpoint_root(panel.sparkSession)
    # Stored once: both ways, and the lengths of the chirps, read it.
    d = detrend(interpolate_linear(panel, keys), keys).checkpoint()
    size, k = F.col("size"), F.col("k")
    wanted = (k >= 1) & (k <= size / 2) & (size / k >= shortest) & (size / k <= longest)
    d = d.withColumns({"_own": _factors(size), "_wide": _room(size)})
    plain = size * (F.col("_own.a") + F.col("_own.b"))
    chirp = 3 * F.col("_wide.a") * F.col("_wide.b") * (F.col("_wide.a") + F.col("_wide.b"))
    by = [*keys, "size"]
    smooth = d.filter(plain <= DETOUR * chirp).select(*by, "_own.a", "_own.b", "j", F.col("d").alias("re"), F.lit(0.0).alias("im"))
    direct = _transform(smooth, by, wanted).select(*by, "k", "re", "im")
    rest = d.filter(plain > DETOUR * chirp).select(*by, "j", "d")
    spectrum = direct.unionByName(_by_chirp(rest, keys, wanted))
    sides = F.when(k * 2 == size, 1.0).otherwise(2.0)
    power = sides * (F.col("re") * F.col("re") + F.col("im") * F.col("im")) / size
    return spectrum.select(*keys, "k", (size / k).alias("period"), power.alias("power"))
