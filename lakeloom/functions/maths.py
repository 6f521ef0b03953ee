"""Score, geometry and vector functions over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GIB = 1024.0**3


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def round6(x: Column) -> Column:
    """Half-up rounding to six digits that every engine computes alike."""
    return F.floor(x * 1e6 + 0.5) / 1e6


def gaussian_bins(mean: Column, sigma: float = 1.0) -> Column:
    """Ten probabilities for the scores 1 to 10, proportional to a normal density around ``mean``."""
    weights = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda b: F.exp(-0.5 * F.pow((b - mean) / sigma, 2)))
    return F.transform(weights, lambda w: w / total(weights))


# Linear scales onto 1 to 10.
def from_five(x: Column) -> Column:
    return 1 + (x - 1) * 2.25


def from_hundred(x: Column) -> Column:
    return 1 + x * 0.09


def from_nine(x: Column) -> Column:
    return x + 1


def from_impairment(x: Column) -> Column:
    """0 (best) to 100 and more (worst)."""
    return 1 + (1 - F.least(F.lit(100.0), x) / 100) * 9


def from_unit_impairment(x: Column) -> Column:
    return 1 + (1 - x) * 9


def from_unit(x: Column) -> Column:
    return x * 9 + 1


def weighted_bins(bins: Column) -> Column:
    """Sum of bin number (from 1) times the bin's value."""
    return F.aggregate(F.transform(bins, lambda v, i: (i + 1) * v), F.lit(0.0), lambda s, x: s + x)


def vote_score(votes: Column, normalize: bool = True) -> Column:
    """Mean score of votes by bin; of raw counts only if they are normalised. Null where there is no vote."""
    return F.try_divide(weighted_bins(votes), total(votes)) if normalize else weighted_bins(votes)


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    return F.transform(logits, lambda x: F.exp(x - top) / F.aggregate(logits, F.lit(0.0), lambda s, y: s + F.exp(y - top)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column) -> Column:
    """The vector over its length; null elements where the length is zero."""
    return F.transform(v, lambda x: F.try_divide(x.cast("double"), norm(v)))


def xyxy_to_xywh(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.array(x1, y1, x2 - x1, y2 - y1)


def box_to_yolo(box: Column, width: Column, height: Column) -> Column:
    """Centre and size of a top-left box, as shares of the image; null elements for an image without area."""
    w, h = width.cast("double"), height.cast("double")
    return F.array(
        round6(F.try_divide(box[0] + box[2] / 2, w)),
        round6(F.try_divide(box[1] + box[3] / 2, h)),
        round6(F.try_divide(box[2].cast("double"), w)),
        round6(F.try_divide(box[3].cast("double"), h)),
    )


def normalize_points(points: Column, width: Column, height: Column, stride: int = 2) -> Column:
    """x and y as shares of the image; with stride 3 every third value (visibility) passes through. A trailing x
    without its y is left out."""
    whole = F.slice(points, 1, (F.floor(F.size(points) / stride) * stride).cast("int"))
    w, h = width.cast("double"), height.cast("double")
    return F.transform(
        whole,
        lambda v, i: F.when(i % stride == 0, round6(F.try_divide(v.cast("double"), w)))
        .when(i % stride == 1, round6(F.try_divide(v.cast("double"), h)))
        .otherwise(v.cast("double")),
    )


def to_gib(n: Column) -> Column:
    return n / GIB


def from_gib(n: Column) -> Column:
    return n * GIB
