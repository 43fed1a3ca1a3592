"""Array arithmetic on embedding columns, in built-in higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column) -> Column:
    """Unit-length doubles; a zero vector stays as it is. The norm is bound once per row."""
    return F.transform(
        F.array(l2_norm(v)),
        lambda n: F.transform(v, lambda x: x.cast("double") / F.when(n == 0, F.lit(1.0)).otherwise(n)),
    )[0]
