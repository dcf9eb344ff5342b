"""Aggregate measures with their exact NULL rules.

The same word ("late rate") has three different NULL treatments in the marts; each is a
separate, named expression so they are never unified by accident:

* ``flag_rate(flag, where)``         CASE WHEN flag THEN 1.0 ELSE 0 END over ``where`` rows:
                                     a NULL flag counts as 0 and stays in the denominator.
* ``strict_flag_rate(flag, where)``  CASE WHEN where AND flag THEN 1.0 WHEN where AND NOT
                                     flag THEN 0 END: a NULL flag leaves the denominator.
* ``conditional_mean(value, where)`` AVG(CASE WHEN where THEN value END).

All indicator literals are doubles, so averages are doubles (never decimal(…,5)) and sums
of 0/1 are exact: the result is one correctly rounded division, independent of shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _one() -> Column:
    return F.lit(1.0)


def _zero() -> Column:
    return F.lit(0.0)


def flag_rate(flag: Column, where: Column | None = None) -> Column:
    indicator = F.when(flag, _one()).otherwise(_zero())
    return F.avg(indicator if where is None else F.when(where, indicator))


def strict_flag_rate(flag: Column, where: Column | None = None) -> Column:
    population = F.lit(True) if where is None else where
    return F.avg(F.when(population & flag, _one()).when(population & ~flag, _zero()))


def conditional_mean(value: Column, where: Column) -> Column:
    return F.avg(F.when(where, value))


def conditional_sum(value: Column, where: Column) -> Column:
    return F.sum(F.when(where, value))
