"""Data-quality expectations as one Spark pass (C10).

``expect(df, rules)`` counts for every rule per value of the unique column, then over those
values, so the data are read once however many unique columns there are, and returns one row
per rule:
(expectation, column, critical, result, unexpected_pct).  ``summary`` condenses the report
to one row and ``enforce`` raises when a critical rule failed — call it before writing marts.

Semantics follow the usual column-map expectation conventions:
* NULL values are ignored by every rule except ``not_null`` (whose unexpected rows are the
  NULLs and whose denominator is all rows); other rules divide by the non-NULL count.
* ``unique`` counts every member of a duplicated group as unexpected.
* ``mostly`` = minimum passing fraction; without it a single unexpected row fails the rule.
* ``unexpected_pct`` is a percentage rounded to 3 places.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Rule:
    kind: str  # not_null | unique | between | in_set
    column: str
    critical: bool = True
    min_value: float | None = None
    max_value: float | None = None
    value_set: tuple = field(default_factory=tuple)
    mostly: float | None = None

    @property
    def expectation(self) -> str:
        return {
            "not_null": "ExpectColumnValuesToNotBeNull",
            "unique": "ExpectColumnValuesToBeUnique",
            "between": "ExpectColumnValuesToBeBetween",
            "in_set": "ExpectColumnValuesToBeInSet",
        }[self.kind]


def not_null(column: str, critical: bool = True, mostly: float | None = None) -> Rule:
    return Rule("not_null", column, critical, mostly=mostly)


def unique(column: str, critical: bool = True) -> Rule:
    return Rule("unique", column, critical)


def between(column: str, min_value=None, max_value=None, critical: bool = True, mostly: float | None = None) -> Rule:
    return Rule("between", column, critical, min_value=min_value, max_value=max_value, mostly=mostly)


def in_set(column: str, values, critical: bool = True, mostly: float | None = None) -> Rule:
    return Rule("in_set", column, critical, value_set=tuple(values), mostly=mostly)


# The fact_orders quality suite (rule, column, bounds, critical, mostly).
FACT_ORDERS_RULES = (
    not_null("order_id", critical=True),
    unique("order_id", critical=True),
    between("revenue", min_value=0, critical=True),
    between("freight", min_value=0, critical=True),
    between("freight_ratio", min_value=0, max_value=10, critical=False, mostly=0.99),
    between("review_score", min_value=1, max_value=5, critical=True),
    between("delay_days", min_value=-120, max_value=240, critical=False, mostly=0.999),
    in_set("is_late", [True, False], critical=True),
    in_set("is_delivered", [True, False], critical=True),
    not_null("region_state", critical=False, mostly=0.98),
)


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, float):
        return repr(v) + "D"
    return repr(v)


def _unexpected(rule: Rule) -> str:
    """SQL predicate for an unexpected row of ``rule`` (NULLs ignored except by not_null)."""
    c = _ident(rule.column)
    if rule.kind == "not_null":
        return f"{c} IS NULL"
    if rule.kind == "between":
        bad = []
        if rule.min_value is not None:
            bad.append(f"{c} < {_literal(rule.min_value)}")
        if rule.max_value is not None:
            bad.append(f"{c} > {_literal(rule.max_value)}")
        return f"{c} IS NOT NULL AND ({' OR '.join(bad) or 'false'})"
    if rule.kind == "in_set":
        return f"{c} IS NOT NULL AND NOT {c} IN ({', '.join(_literal(v) for v in rule.value_set)})"
    raise ValueError(rule.kind)


def expect(df: DataFrame, rules=FACT_ORDERS_RULES, with_rows: bool = False) -> DataFrame:
    """Evaluate ``rules`` over ``df``; one row per rule, in rule order (``with_rows`` adds
    the checked row count to every row).

    The rule counts and the report are written as SQL expressions (one ``stack`` for the
    report), so building the plan costs a handful of calls whatever the number of rules."""
    keys = list(dict.fromkeys(r.column for r in rules if r.kind == "unique"))
    # with several unique columns every row is listed once per column, the rules counted on the first listing
    first = "_tag = 0 AND " if len(keys) > 1 else ""
    aggs = [f"count_if({first}true) AS _rows"]
    for i, r in enumerate(rules):
        aggs.append(f"count_if({first}{_ident(r.column)} IS NOT NULL) AS _nn{i}")
        if r.kind != "unique":
            aggs.append(f"count_if({first}({_unexpected(r)})) AS _bad{i}")
    names = [a.rsplit(" AS ", 1)[1] for a in aggs]
    if keys:
        # the counts of all rules per key first, map-side, then over the keys: the data are read once, and a
        # value of any unique column meets its like in one exchange
        listed, tags = df, [F.lit(0).alias("_tag")]
        if len(keys) > 1:
            listed, tags = df.withColumn("_tag", F.explode(F.sequence(F.lit(0), F.lit(len(keys) - 1)))), [F.col("_tag")]
        by = [F.when(F.col("_tag") == i, F.col(_ident(k))).alias(f"_key{i}") if len(keys) > 1 else F.col(_ident(k)).alias("_key0")
              for i, k in enumerate(keys)]
        per_key = listed.groupBy(*tags, *by).agg(F.expr("count(1) AS _in"), *[F.expr(a) for a in aggs])
        outer = [f"coalesce(sum({n}), 0) AS {n}" for n in names]
        for i, r in enumerate(rules):
            if r.kind == "unique":
                k = keys.index(r.column)
                repeated = f"_tag = {k} AND _key{k} IS NOT NULL AND _in > 1"
                outer.append(f"CAST(coalesce(sum(CASE WHEN {repeated} THEN _in END), 0) AS BIGINT) AS _bad{i}")
        stats = per_key.agg(*[F.expr(a) for a in outer])
    else:
        stats = df.agg(*[F.expr(a) for a in aggs])

    entries = []
    for i, r in enumerate(rules):
        bad = f"CAST(_bad{i} AS DOUBLE)"
        base = "CAST(_rows AS DOUBLE)" if r.kind == "not_null" else f"CAST(_nn{i} AS DOUBLE)"
        if r.mostly is None:
            ok = f"_bad{i} = 0"
        else:
            ok = f"({base} = 0 OR ({base} - {bad}) / {base} >= {_literal(float(r.mostly))})"
        pct = f"CASE WHEN {base} > 0 THEN floor((100.0D * {bad} / {base}) * 1000.0D + 0.5D) / 1000.0D ELSE 0.0D END"
        entries.append(
            f"{_literal(r.expectation)}, {_literal(r.column)}, {_literal('yes' if r.critical else 'no')}, "
            f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END, {pct}"
        )
    report = f"stack({len(rules)}, {', '.join(entries)}) AS (expectation, `column`, critical, result, unexpected_pct)"
    # a single aggregate row stacked in rule order: no sort needed
    out = stats.selectExpr(report, "_rows AS rows")
    return out if with_rows else out.drop("rows")


def summary(report: DataFrame) -> DataFrame:
    """One row: rows checked, rules, passed, failed, critical failures.  ``report`` comes
    from ``expect(..., with_rows=True)``."""
    failed = F.col("result") == "FAIL"
    return report.agg(
        F.max("rows").cast("long").alias("rows"),
        F.count(F.lit(1)).cast("long").alias("expectations"),
        F.count_if(~failed).cast("long").alias("passed"),
        F.count_if(failed).cast("long").alias("failed"),
        F.count_if(failed & (F.col("critical") == "yes")).cast("long").alias("critical_failed"),
    )


class QualityGateError(RuntimeError):
    pass


def enforce(report: DataFrame) -> DataFrame:
    """Raise ``QualityGateError`` if any critical rule failed; otherwise return the report
    as an in-memory DataFrame of the evaluated rows, so writing it afterwards does not
    evaluate the rules over the data a second time.

    Collects only the report (one small row per rule)."""
    rows = report.collect()
    failures = [r for r in rows if r["result"] == "FAIL" and r["critical"] == "yes"]
    if failures:
        raise QualityGateError(
            "critical data-quality failure(s): " + ", ".join(f"{r['expectation']}({r['column']})" for r in failures)
        )
    return report.sparkSession.createDataFrame(rows, report.schema)
