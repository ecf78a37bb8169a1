"""Small column builders shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86400


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def number(col: Column | str, default: float = 0.0) -> Column:
    """Lenient number: text that does not parse, and null, become the default."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.try_cast("double"), F.lit(default))


def half_even(col: Column, places: int) -> Column:
    """Round to ``places`` with ties to the even digit."""
    return F.bround(col, places)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days elapsed, floored towards minus infinity (not calendar days)."""
    micros = (F.unix_micros(later) - F.unix_micros(earlier)).cast("double")
    return F.floor(micros / (DAY_SECONDS * 1e6))


def cut(value: Column, edges: Sequence[float], labels: Sequence, lowest: bool = True,
        otherwise=None) -> Column:
    """Label of the right-closed interval holding ``value``.

    ``edges`` has one entry more than ``labels``.  ``lowest`` closes the first
    interval on the left.  Values outside every interval, and nulls, give
    ``otherwise``.
    """
    inside_low = value >= F.lit(float(edges[0])) if lowest else value > F.lit(float(edges[0]))
    result = F.when(value.isNull() | ~inside_low, F.lit(otherwise))
    for upper, label in zip(edges[1:], labels):
        result = result.when(value <= F.lit(float(upper)), F.lit(label))
    return result.otherwise(F.lit(otherwise))


def ladder(value: Column, steps: Iterable[tuple], missing, inclusive: bool = True) -> Column:
    """First step whose bound holds the value; a ``None`` bound takes the rest; nulls give ``missing``."""
    result = F.when(value.isNull(), F.lit(missing))
    for bound, label in steps:
        if bound is None:
            return result.otherwise(F.lit(label))
        result = result.when(value <= bound if inclusive else value < bound, F.lit(label))
    return result


def lookup(key: Column, mapping: Mapping, default=None) -> Column:
    """Constant dictionary lookup, evaluated inside the row expression."""
    result = None
    for k, v in mapping.items():
        result = F.when(key == F.lit(k), F.lit(v)) if result is None else result.when(key == F.lit(k), F.lit(v))
    return result.otherwise(F.lit(default))


def any_of(text: Column, words: Iterable[str]) -> Column:
    """True when the text holds one of the literal words (case matters)."""
    result = None
    for word in words:
        hit = F.contains(text, F.lit(word))
        result = hit if result is None else result | hit
    return result


def cut_by_edges(value: Column, edges: Column) -> Column:
    """Zero-based code of the right-closed quantile interval.

    ``edges`` is an ascending array of distinct edges; the lowest edge belongs to
    the first interval.
    """
    below = F.size(F.filter(edges, lambda e: e < value))
    return F.when(value.isNull() | (F.size(edges) < 2), F.lit(None).cast("int")).otherwise(
        F.greatest(below - 1, F.lit(0)))


def equal_width_code(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Zero-based code of the right-closed equal-width interval over [low, high]."""
    width = (high - low) / F.lit(float(bins))
    code = None
    for i in range(1, bins):
        hit = value <= low + width * F.lit(float(i))
        code = F.when(hit, F.lit(i - 1)) if code is None else code.when(hit, F.lit(i - 1))
    return F.when(value.isNotNull(), code.otherwise(F.lit(bins - 1)))
