"""The alert rule and what follows from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torquelake.config import AlertRules


def rule_columns(rules: AlertRules) -> dict[str, Column]:
    """The three rules. A rule over a missing value is NULL."""
    return {
        "is_speeding": F.col("speed") > rules.max_speed,
        "is_wrong_gear": F.col("expected_gear") != F.col("gear"),
        "is_high_rpm": F.col("rpm") > rules.max_rpm,
    }


def flag_alerts(enriched: DataFrame, rules: AlertRules) -> DataFrame:
    """Add ``is_alert``: true if any rule holds, false otherwise, never NULL."""
    any_rule = reduce(Column.__or__, rule_columns(rules).values())
    return enriched.withColumn("is_alert", F.coalesce(any_rule, F.lit(False)))


def only_alerts(flagged: DataFrame) -> DataFrame:
    return flagged.filter("is_alert").drop("is_alert")


def alert_reasons(flagged: DataFrame, rules: AlertRules) -> DataFrame:
    """One column per rule, and the names of those that fired."""
    fired = {name: F.coalesce(rule, F.lit(False)) for name, rule in rule_columns(rules).items()}
    names = [F.when(F.col(name), F.lit(name.removeprefix("is_"))) for name in fired]
    return flagged.withColumns(fired).withColumn("reasons", F.concat_ws(",", *names))
