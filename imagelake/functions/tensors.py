"""Picture arithmetic as column expressions.

A picture is ``pixels ARRAY<FLOAT|DOUBLE>`` in row-major HWC order with its
``height``, ``width`` and ``n_channels``. Every function here is a higher-order
SQL function (``transform`` / ``aggregate`` / ``filter``), so it runs in the
JVM per row with no Python. Index arithmetic uses 0-based positions ``i``;
``element_at`` is 1-based. Shapes may be ints or columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import IMAGENET_MEAN, IMAGENET_STD


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def _at(px: Column, i: Column) -> Column:
    """0-based element."""
    return F.element_at(px, (i + 1).cast("int"))


def _idiv(a: Column, b: Column) -> Column:
    """Integer division of non-negative ints."""
    return (a / b).cast("int")


def scale_unit(px) -> Column:
    """x / 255 (D1)."""
    return F.transform(_c(px), lambda x: x.cast("double") / 255.0)


def scale_signed(px) -> Column:
    """x / 127.5 - 1, i.e. [0, 255] -> [-1, 1]."""
    return F.transform(_c(px), lambda x: x.cast("double") / 127.5 - 1.0)


def _per_channel(values: list[float], i: Column, c) -> Column:
    arr = F.array(*[F.lit(float(v)) for v in values])
    return F.element_at(arr, (i % _c(c) + 1).cast("int"))


def standardize(px, mean: list[float] | None = None, std: list[float] | None = None,
                n_channels=3) -> Column:
    """(x / 255 - mean[ch]) / std[ch] with ImageNet statistics by default (D3)."""
    mean = IMAGENET_MEAN if mean is None else mean
    std = IMAGENET_STD if std is None else std
    return F.transform(_c(px), lambda x, i: (x.cast("double") / 255.0 - _per_channel(mean, i, n_channels))
                       / _per_channel(std, i, n_channels))


def destandardize(px, mean: list[float] | None = None, std: list[float] | None = None,
                  n_channels=3) -> Column:
    """Inverse of ``standardize`` to [0, 1], clipped."""
    mean = IMAGENET_MEAN if mean is None else mean
    std = IMAGENET_STD if std is None else std
    return F.transform(_c(px), lambda v, i: F.least(F.greatest(
        v * _per_channel(std, i, n_channels) + _per_channel(mean, i, n_channels), F.lit(0.0)), F.lit(1.0)))


def to_rgb(px, height, width, n_channels) -> Column:
    """3-channel RGB from BGR (swap), grey (repeat) or BGRA (drop alpha, swap).
    Applying it to RGB input gives BGR, so it is its own inverse for 3 channels."""
    px, h, w, c = _c(px), _c(height), _c(width), _c(n_channels)

    def src(j):
        p, ch = _idiv(j, F.lit(3)), j % 3
        return F.when(c == 1, _at(px, p)).otherwise(_at(px, p * c + 2 - ch))

    return F.transform(F.sequence(F.lit(0), h * w * 3 - 1), src)


def resize_nearest(px, height, width, n_channels, out_h: int, out_w: int) -> Column:
    """Nearest-neighbour resize: output (y, x) reads source
    (floor(y * h / out_h), floor(x * w / out_w)) (D6)."""
    px, h, w, c = _c(px), _c(height), _c(width), _c(n_channels)
    oh, ow = F.lit(out_h), F.lit(out_w)

    def src(j):
        y = _idiv(j, ow * c)
        x = _idiv(j, c) % ow
        ch = j % c
        sy = _idiv(y * h, oh)
        sx = _idiv(x * w, ow)
        return _at(px, (sy * w + sx) * c + ch)

    return F.transform(F.sequence(F.lit(0), oh * ow * c - 1), src)


def has_shape(px, height, width, n_channels) -> Column:
    """Pixel count equals h * w * c and the picture decoded."""
    h, w, c = _c(height), _c(width), _c(n_channels)
    return (h > 0) & (F.size(_c(px)) == h * w * c)


def minmax(px) -> Column:
    """(x - min) / (max - min) per vector; null when the range is zero."""
    px = _c(px)
    lo, hi = F.array_min(px).cast("double"), F.array_max(px).cast("double")
    return F.when(hi > lo, F.transform(px, lambda x: (x.cast("double") - lo) / (hi - lo)))


def _sum(px: Column) -> Column:
    return F.aggregate(px, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def var_pop(px) -> Column:
    """Population variance of a vector (two passes, sequential sums)."""
    px = _c(px)
    mean = _sum(px) / F.size(px)
    return F.aggregate(px, F.lit(0.0),
                       lambda acc, x: acc + (x.cast("double") - mean) * (x.cast("double") - mean)) / F.size(px)


# fixed values: variance tiers of filter inspection.
VAR_ACTIVE = 0.01
VAR_MODERATE = 0.005


def variance_tier(px, hi: float = VAR_ACTIVE, lo: float = VAR_MODERATE) -> Column:
    """``active`` above ``hi``, ``moderate`` above ``lo``, else ``soft``."""
    v = var_pop(px)
    return F.when(v > hi, "active").when(v > lo, "moderate").otherwise("soft")


def pool_channels(px, n_channels, mode: str = "avg") -> Column:
    """Global average or max pooling per channel: ``ARRAY<DOUBLE>`` of length c."""
    px, c = _c(px), _c(n_channels)

    def one(k):
        vals = F.filter(px, lambda x, i: i % c == k)
        if mode == "max":
            return F.array_max(vals).cast("double")
        return _sum(vals) / F.size(vals)

    return F.transform(F.sequence(F.lit(0), c - 1), one)


def channel_mean(px, height, width, n_channels) -> Column:
    """Mean over the channel axis at every position: ``ARRAY<DOUBLE>`` of h * w."""
    px, h, w, c = _c(px), _c(height), _c(width), _c(n_channels)
    return F.transform(F.sequence(F.lit(0), h * w - 1),
                       lambda p: _sum(F.slice(px, (p * c + 1).cast("int"), c)) / c)


def flip_h(px, height, width, n_channels) -> Column:
    """Mirror every row."""
    px, w, c = _c(px), _c(width), _c(n_channels)

    def src(_x, j):
        y = _idiv(j, w * c)
        x = _idiv(j, c) % w
        return _at(px, (y * w + (w - 1 - x)) * c + j % c)

    return F.transform(px, src)


def brightness_contrast(px, brightness, contrast) -> Column:
    """clip(x * (1 + contrast) + 255 * brightness, 0, 255) on [0, 255] pixels."""
    b, k = _c(brightness), _c(contrast)
    return F.transform(_c(px), lambda x: F.least(F.greatest(
        x.cast("double") * (1 + k) + 255.0 * b, F.lit(0.0)), F.lit(255.0)))
