"""Array column expressions (all JVM-side, inside whole-stage codegen).

Covers P6 (scale to a range), P7 (per-channel mean subtraction), P16
(feature vector from columns) and the vector maths used by V1/V2.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.constants import IMAGENET_MEANS_RGB


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double_array(c) -> Column:
    """FLOAT arrays are widened before any arithmetic (stable sums)."""
    return F.transform(_col(c), lambda x: x.cast("double"))


def dot(a, b) -> Column:
    """Dot product of two equal-length numeric arrays."""
    return F.aggregate(
        F.zip_with(as_double_array(a), as_double_array(b), lambda x, y: x * y),
        F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(as_double_array(a), lambda x: x * x),
                              F.lit(0.0), lambda acc, x: acc + x))


def cosine(a, b) -> Column:
    """Cosine similarity; NULL when either side is NULL or has zero norm."""
    den = l2_norm(a) * l2_norm(b)
    return F.when(den > 0, dot(a, b) / den)


def scale_pixels(c, lo: float = 0.0, hi: float = 1.0, max_value: float = 255.0) -> Column:
    """Map [0, max_value] to [lo, hi]."""
    span = float(hi) - float(lo)
    return F.transform(as_double_array(c),
                       lambda x: x / F.lit(float(max_value)) * F.lit(span) + F.lit(float(lo)))


def scale_minmax(c, src_min, src_max, lo: float = 0.0, hi: float = 1.0) -> Column:
    """P6 with a data-derived source range (columns or literals)."""
    src_min = src_min if isinstance(src_min, Column) else F.lit(float(src_min))
    src_max = src_max if isinstance(src_max, Column) else F.lit(float(src_max))
    span = float(hi) - float(lo)
    return F.transform(as_double_array(c),
                       lambda x: (x - src_min) / (src_max - src_min) * F.lit(span) + F.lit(float(lo)))


def subtract_channel_means(c, means: Sequence[float], channel_last: bool = False,
                           plane_size: int | None = None) -> Column:
    """Subtract a per-channel mean from a flat array.

    ``channel_last=True``: layout ...,c (HWC) so channel = i mod C.
    ``channel_last=False``: layout c,h,w (CHW) so channel = i div plane_size.
    """
    m = F.array(*[F.lit(float(v)) for v in means])
    nch = len(means)
    if channel_last:
        return F.transform(as_double_array(c), lambda x, i: x - F.element_at(m, (i % nch) + 1))
    if plane_size is None:
        raise ValueError("plane_size is required for channel-first layout")
    return F.transform(as_double_array(c),
                       lambda x, i: x - F.element_at(m, F.floor(i / plane_size).cast("int") + 1))




def imagenet_preprocess(c, plane_size: int) -> Column:
    """P7 with the fixed ImageNet means, for CHW features in RGB order (the
    layout produced by ``sources.images.to_features``)."""
    return subtract_channel_means(c, IMAGENET_MEANS_RGB, channel_last=False, plane_size=plane_size)


def feature_array(*cols) -> Column:
    """The feature vector of a record = its feature cells, as doubles."""
    return F.array(*[_col(c).cast("double") for c in cols])


def argmax(c) -> Column:
    """0-based position of the first maximum; NULL for NULL/empty arrays."""
    arr = _col(c)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")
