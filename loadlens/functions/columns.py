"""Scalar Column helpers shared by the operators.

They encode the numeric conventions of the run analytics:
* division by zero gives NULL (ANSI-safe ``try_divide``), never an error;
* a comparison with a missing value is 0, not NULL, once turned into a flag;
* value bins are half-open ``(lo, hi]`` with the lowest edge excluded, and
  values outside every bin are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div(a, b) -> Column:
    """a / b as double; NULL when b is 0 or NULL."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 where NULL counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def cut(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Half-open ``(edges[i], edges[i+1]]`` binning; outside → NULL."""
    assert len(edges) == len(labels) + 1
    x = col(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = x > F.lit(float(lo))
        if hi != float("inf"):
            cond = cond & (x <= F.lit(float(hi)))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def mean_of(cols: Sequence) -> Column:
    """Row-wise mean of a fixed list of non-null columns."""
    cs = [col(c) for c in cols]
    total = cs[0]
    for c in cs[1:]:
        total = total + c
    return total / F.lit(float(len(cs)))


def sample_std_of(cols: Sequence) -> Column:
    """Row-wise sample (n-1) standard deviation of a fixed list of columns."""
    cs = [col(c) for c in cols]
    m = mean_of(cs)
    ss = None
    for c in cs:
        d = (c - m) * (c - m)
        ss = d if ss is None else ss + d
    return F.sqrt(ss / F.lit(float(len(cs) - 1)))


def rounded(c, digits: int = 6) -> Column:
    return F.round(col(c), digits)
