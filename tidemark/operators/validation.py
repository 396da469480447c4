"""Checking loaded tables against expected aggregates, and rolling up run results.

Rules on one table are worked out together in one pass over it; a rule that computes its
own columns shares a pass with the rules that compute the same ones.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas

# Aggregates a rule may name.
AGGREGATES = {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}
_AGGREGATE_RULE = re.compile(r"(\w+)\((.*)\)")


@dataclass(frozen=True)
class Rule:
    """``rule_calc`` is ``aggregate(expression)``, or anything else for a single value.

    A single-value rule takes the first of ``columns`` from a table of exactly one row.
    ``sql_calc`` computes the columns first: in it ``tbl_name`` stands for the table and
    ``{0}``, ``{1}``… for ``sql_calc_apply``.
    """

    rule_id: str
    table: str
    rule_calc: str
    columns: tuple[str, ...]
    expect_value: float
    operation: str
    sql_calc: str = ""
    sql_calc_apply: tuple[str, ...] = field(default=())
    margin_pct: float = 0.0

    @property
    def projection(self) -> str | None:
        if not (self.sql_calc and self.sql_calc_apply):
            return None
        text = self.sql_calc
        for place, argument in enumerate(self.sql_calc_apply):
            text = text.replace(f"{{{place}}}", argument)
        return text


def _projected(df: DataFrame, projection: str | None) -> DataFrame:
    """The computed columns alone; ``tbl_name`` is the alias they may use for the table."""
    if projection is None:
        return df
    return df.sparkSession.sql(f"SELECT {projection} FROM {{validated}} AS tbl_name", validated=df)


def _measure(rule: Rule, columns: list[str]) -> tuple[Column, Column]:
    """The rule's value and what is wrong with it, over one grouped row."""
    none = F.lit(None).cast("string")
    parsed = _AGGREGATE_RULE.fullmatch(rule.rule_calc)
    if parsed is None:
        first = rule.columns[0] if rule.columns else columns[0]
        return (
            F.when(F.count(F.lit(1)) == 1, F.max(F.col(first).cast("double"))),
            F.when(F.count(F.lit(1)) != 1, F.lit("needs exactly one row")).otherwise(none),
        )
    name, expression = parsed.groups()
    aggregate = AGGREGATES.get(name.lower())
    if aggregate is None:
        return F.lit(None).cast("double"), F.lit(f"unsupported aggregate: {name}")
    return aggregate(F.expr(expression)).cast("double"), none


def rules_of(table: DataFrame) -> list[Rule]:
    """Rules from a table of rules (``schemas.VALIDATION_RULES``); it is small configuration.

    ``apply_cols`` and ``sql_calc_apply`` are lists; missing texts and numbers count as empty.
    """
    return [
        Rule(
            r["rule_id"], r["table"], r["rule_calc"], tuple(r["apply_cols"] or ()), r["expect_value"], r["operation"],
            r["sql_calc"] or "", tuple(r["sql_calc_apply"] or ()), r["margin_pct"] or 0.0,
        )
        for r in schemas.conform(table, schemas.VALIDATION_RULES).collect()
    ]


def within_tolerance(value: Column, expect: Column, operation: Column, margin: Column) -> Column:
    """The comparison with its margin; null for an unknown operation.

    The margin is a share of the size of the expected value, so it widens the range of a
    negative one too.
    """
    slack = F.abs(expect) * margin / 100
    low, high = expect - slack, expect + slack
    return (
        F.when(operation == ">=", value >= low)
        .when(operation == "<=", value <= high)
        .when(operation == "==", value.between(low, high))
        .when(operation == ">", value > low)
        .when(operation == "<", value < high)
    )


def evaluate(rules: Iterable[Rule], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per rule: its value, verdict and, when it failed outright, the reason."""
    passes: dict[tuple[str, str | None], list[Rule]] = defaultdict(list)
    for rule in rules:
        passes[rule.table, rule.projection].append(rule)
    results = []
    for (table, projection), group in passes.items():
        rows = _projected(tables[table], projection)
        measured = [
            F.struct(
                F.lit(rule.rule_id).alias("rule_id"), value.alias("value"),
                problem.alias("problem"), F.lit(float(rule.expect_value)).alias("expect_value"),
                F.lit(rule.operation).alias("operation"),
                F.lit(float(rule.margin_pct)).alias("margin_pct"),
            )
            for rule in group
            for value, problem in [_measure(rule, rows.columns)]
        ]
        results.append(rows.agg(F.array(*measured).alias("rules")).select(F.inline("rules")))
    verdict = within_tolerance(
        F.col("value"), F.col("expect_value"), F.col("operation"), F.col("margin_pct")
    )
    return (
        reduce(DataFrame.unionByName, results)
        .withColumn("verdict", verdict)
        .withColumn("reason", F.coalesce(
            "problem",
            F.when(F.col("value").isNull(), "no value"),
            F.when(F.col("verdict").isNull(), F.concat(F.lit("unsupported operation: "), "operation")),
        ))
        .select("rule_id", "value",
                (F.col("reason").isNull() & F.coalesce("verdict", F.lit(False))).alias("is_valid"),
                "reason")
    )


def staged_row_counts(staged: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("row_cnt")).select(F.lit(name).alias("staged"), "row_cnt")
        for name, df in staged.items()
    ])


def group_result(items: DataFrame) -> DataFrame:
    """Per run, how its items ended: any item not successful makes the run fail.

    ``items`` holds ``run_id`` and ``status``. The text lists each status with its count,
    so a run of any number of items yields a short one. An item without a status has not
    succeeded and is listed as ``none``.
    """
    failed = ~F.coalesce(F.col("status").isin(*schemas.SUCCEEDED), F.lit(False))
    by_status = items.groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("n"))
    entry = F.concat_ws("=", F.coalesce("status", F.lit("none")), F.col("n").cast("string"))
    return by_status.groupBy("run_id").agg(
        F.sum("n").alias("item_cnt"),
        F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("error_cnt"),
        F.array_join(F.sort_array(F.collect_list(F.when(failed, entry))), ", ").alias("_errors"),
    ).select(
        "run_id", "item_cnt", "error_cnt",
        F.when(F.col("error_cnt") == 0, "SUCCESS").otherwise(schemas.FAILED).alias("status"),
        F.when(F.col("error_cnt") == 0, "").otherwise(
            F.concat(F.lit("There is error on "), "error_cnt", F.lit(" of "), "item_cnt",
                     F.lit(" items: "), "_errors")
        ).alias("message"),
    )
