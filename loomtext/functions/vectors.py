"""Vector expressions on array columns, computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (
    AMBIGUOUS_MATCH,
    STRONG_MATCH,
    VERDICT_AMBIGUOUS,
    VERDICT_STRONG,
    VERDICT_UNRELATED,
)
from .text import col, let


def as_double(v: Column | str) -> Column:
    return col(v).cast("array<double>")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _total(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def norm(v: Column | str) -> Column:
    return F.sqrt(_total(F.transform(as_double(v), lambda x: x * x)))


def euclidean(a: Column | str, b: Column | str) -> Column:
    gaps = F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(_total(gaps))


def l2_normalize(v: Column | str) -> Column:
    """Scale to norm 1; the zero vector stays zero."""

    def scaled(d: Column) -> Column:
        return let(
            norm(d),
            lambda n: F.transform(d, lambda x: F.when(n == 0, F.lit(0.0)).otherwise(x / n)),
        )

    return let(as_double(v), scaled)


def verdict(cosine: Column | str) -> Column:
    c = col(cosine)
    return (
        F.when(c > STRONG_MATCH, F.lit(VERDICT_STRONG))
        .when(c > AMBIGUOUS_MATCH, F.lit(VERDICT_AMBIGUOUS))
        .otherwise(F.lit(VERDICT_UNRELATED))
    )
