"""Score helpers: every score is a double in 0..1, or null where it is missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(c: Column) -> Column:
    """NaN as null, so that a missing value never counts as a large one."""
    return F.when(~F.isnan(c.cast("double")), c.cast("double"))


def clip01(c: Column) -> Column:
    """c limited to 0..1; null and NaN stay missing (least and greatest would skip them).

    c stands once in the result and is computed once: nested scores would otherwise grow by a factor a level.
    """

    def limited(x: Column) -> Column:
        return F.when(~F.isnan(x), F.greatest(F.least(x, F.lit(1.0)), F.lit(0.0)))

    return F.transform(F.array(c.cast("double")), limited)[0]
