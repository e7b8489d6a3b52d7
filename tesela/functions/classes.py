"""Classes, ratios and other row-level derivations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exact import as_col

__all__ = [
    "LEVELS",
    "bucketize",
    "speed_class",
    "safe_ratio",
    "by_cuts",
    "median_side",
    "segment_class",
    "log10_floor",
    "clamp",
    "gap",
    "ordinal",
    "label_map",
]

# Level names, lowest first.
LEVELS = ("baja", "media", "alta")


def bucketize(
    c: Column | str, cuts: Sequence[object], labels: Sequence[str], closed: Sequence[str]
) -> Column:
    """Label by ascending `cuts`; `closed[i]` tells whether cut i belongs to the class below
    ('right') or to the class above ('left').  Null stays null.  Cuts may be columns."""
    if not len(cuts) == len(closed) == len(labels) - 1:
        raise ValueError("need one label more than cuts and one closed side per cut")
    c = as_col(c)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for cut, side, label in zip(cuts, closed, labels):
        out = out.when(c <= cut if side == "right" else c < cut, label)
    return out.otherwise(labels[-1])


def speed_class(c: Column | str) -> Column:
    """Below 10 low, 10 up to and including 100 middle, above 100 high."""
    return bucketize(c, [10, 100], LEVELS, ["left", "right"])


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, or null unless the denominator is positive."""
    num, den = as_col(num), as_col(den)
    return F.when(den > 0, num.cast("double") / den)


def by_cuts(
    c: Column | str, low: float | None, high: float | None, labels: Sequence[str] = LEVELS
) -> Column:
    """Three classes by two data-driven cuts, each cut belonging to the class below it.
    Without cuts (no data) the class is null."""
    if low is None or high is None:
        return F.lit(None).cast("string")
    return bucketize(c, [low, high], labels, ["right", "right"])


def median_side(c: Column | str, median: float, high: str, low: str) -> Column:
    return F.when(as_col(c) >= median, high).otherwise(low)


def segment_class(c: Column | str) -> Column:
    """Customer segment from free text; residential words win over business words."""
    text = F.lower(as_col(c))

    def mentions(*words: str) -> Column:
        return text.rlike("|".join(words))

    return (
        F.when(text.isNull(), "Sin clasificar")
        .when(mentions("residencial", "estrato"), "Residencial")
        .when(mentions("corporativo", "empresa"), "Corporativo")
        .otherwise("Otro")
    )


def log10_floor(c: Column | str, floor: float = 1e-10) -> Column:
    return F.log10(as_col(c) + F.lit(floor))


def clamp(c: Column | str, low: float, high: float) -> Column:
    """Value held inside [low, high]; null stays null."""
    c = as_col(c)
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c).cast("double")


def gap(a: Column | str, b: Column | str, digits: int = 2) -> Column:
    return F.round(as_col(a) - as_col(b), digits)


def ordinal(c: Column | str, order: Sequence[str] = LEVELS) -> Column:
    """Position of a label in a fixed order, counted from 1; unknown labels come last."""
    position = F.array_position(F.array(*[F.lit(v) for v in order]), as_col(c))
    return F.when(position > 0, position).otherwise(len(order) + 1).cast("int")


def label_map(c: Column | str, labels: Mapping[str, str]) -> Column:
    """Display label of a code; codes without a label are shown as they are."""
    c = as_col(c)
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)
