"""Data-quality checks.

Each check comes as the offending rows, a count, or both. Counting checks reduce on the map side before they
shuffle, so a key that holds a large share of the rows costs one partial row per task.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import all_of, any_of, equals_all


# --- volume and keys ---------------------------------------------------------------------------------------------


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("Row_Count"))


def distinct_count(df: DataFrame, columns: Sequence[str], *, approx: bool = False) -> DataFrame:
    """Distinct values of one column or a tuple; rows with a NULL component do not count.

    ``approx`` trades exactness (about 5 % relative deviation) for a shuffle of one sketch per task.
    """
    if approx:
        complete = all_of(F.col(c).isNotNull() for c in columns)
        counted = F.approx_count_distinct(F.when(complete, F.xxhash64(*columns)))
    else:
        counted = F.count_distinct(*[F.col(c) for c in columns])
    return df.agg(counted.alias("Distinct_Count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a column, for instance the months a table covers."""
    return df.select(column).distinct().orderBy(column)


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct complete keys, keys that repeat, and rows beyond the first of their key."""
    complete = all_of(F.col(k).isNotNull() for k in keys)
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("Row_Count"),
            F.count_if(complete).alias("Distinct_Keys"),
            F.count_if(F.col("n") > 1).alias("Duplicate_Groups"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("Excess_Rows"),
        )
    )


def duplicate_groups(df: DataFrame, keys: Sequence[str], value: str | None = None, *, distinct_as: str = "Distinct_Demand_Values") -> DataFrame:
    """Keys that occur more than once.

    With ``value`` also the number of distinct non-NULL values and whether the copies are ``exact`` (all alike, all
    NULL included) or ``conflicting``.
    """
    counted = F.count("*").alias("Row_Count")
    if value is None:
        return df.groupBy(*keys).agg(counted).filter(F.col("Row_Count") > 1)
    # One pass with what is summed on the map side. Only keys with different values and more than two of them need their
    # values counted, in a second pass over just their rows.
    repeated = (
        df.groupBy(*keys)
        .agg(counted, F.count(value).alias("filled"), F.min(value).alias("least"), F.max(value).alias("most"))
        .filter(F.col("Row_Count") > 1)
        .withColumn("open", F.coalesce((F.col("least") != F.col("most")) & (F.col("filled") > 2), F.lit(False)))
    )
    settled = repeated.filter(~F.col("open")).withColumn(
        distinct_as, F.when(F.col("filled") == 0, 0).when(F.col("least") == F.col("most"), 1).otherwise(2).cast("bigint")
    )
    conflicting = (
        _rows_with_keys(df, repeated.filter("open"), keys)
        .groupBy(*keys)
        .agg(counted, F.count(value).alias("filled"), F.count_distinct(value).alias(distinct_as))
    )
    found = [*keys, "Row_Count", "filled", distinct_as]
    one_value = (F.col(distinct_as) == 1) & (F.col("filled") == F.col("Row_Count"))
    return (
        settled.select(*found)
        .unionByName(conflicting.select(*found))
        .withColumn("Duplicate_Class", F.when((F.col("filled") == 0) | one_value, "exact").otherwise("conflicting"))
        .drop("filled")
    )


def _rows_with_keys(df: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is among ``found``; NULL keys compare as equal.

    A semi-join: adaptive execution broadcasts a short list of keys, and splits a hot key of the rows otherwise.
    """
    listed = found.select(*[F.col(k).alias(f"_{k}") for k in keys])
    return df.join(listed, all_of(F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys), "left_semi")


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key repeats, to inspect the copies side by side."""
    return _rows_with_keys(df, duplicate_groups(df, keys), keys)


def rows_matching(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows with the given column values (None for NULL)."""
    return df.filter(equals_all(values))


def dedupe_exact(df: DataFrame) -> DataFrame:
    """Drop copies that agree in every column. Conflicting duplicates stay: see `duplicate_groups`."""
    return df.distinct()


def dedupe_loss(df: DataFrame) -> DataFrame:
    """What `dedupe_exact` would remove, in one pass."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("Rows_Before"),
            F.count("*").alias("Rows_After"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("Rows_Removed"),
        )
    )


# --- missing and invalid values ----------------------------------------------------------------------------------


def required_fields(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that miss at least one of the columns."""
    return df.filter(any_of(F.col(c).isNull() for c in columns))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: total rows and ``Null_<column>`` counts, zero for an empty table."""
    return df.agg(F.count("*").alias("Total_Rows"), *[F.count_if(F.col(c).isNull()).alias(f"Null_{c}") for c in columns])


@dataclass(frozen=True)
class Rule:
    """A named SQL condition that marks a row as invalid. An unknown (NULL) condition does not."""

    name: str
    condition: str

    @property
    def violated(self) -> Column:
        return F.expr(self.condition)


def non_negative(*columns: str) -> list[Rule]:
    return [Rule(f"Negative_{c}", f"`{c}` < 0") for c in columns]


def not_above(column: str, limit: str) -> Rule:
    return Rule(f"{column}_Above_{limit}", f"`{column}` > `{limit}`")


def range_violations(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Rows that break a rule, with the names of all rules they break."""
    names = F.concat_ws(",", *[F.when(rule.violated, rule.name) for rule in rules])
    return df.withColumn("Violated_Rules", names).filter(F.col("Violated_Rules") != "")


def rule_counts(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Violations per rule, zero included, from one scan."""
    return unpivot(df, [(rule.name, F.count_if(rule.violated)) for rule in rules])


def unpivot(df: DataFrame, counts: Sequence[tuple[str, Column]]) -> DataFrame:
    """Aggregate ``df`` to named counts and return them as (Check_Name, Violations) rows."""
    as_row = df.agg(*[count.alias(f"c{i}") for i, (_, count) in enumerate(counts)])
    pairs = [F.struct(F.lit(name).alias("Check_Name"), F.col(f"c{i}").alias("Violations")) for i, (name, _) in enumerate(counts)]
    return as_row.select(F.inline(F.array(*pairs)))


# --- references between tables -----------------------------------------------------------------------------------


def orphans(fact: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key the master lacks; a NULL key is an orphan.

    Distinct keys meet the master, reduced on the map side first; the rows of the (usually few) orphan keys are then picked
    by a semi-join. Rows without key, which may be many, need no join at all.
    """
    named = fact.filter(F.col(key).isNotNull())
    missing = named.select(key).distinct().join(master.select(key), key, "left_anti")
    return _rows_with_keys(named, missing, [key]).unionByName(fact.filter(F.col(key).isNull()))


def orphan_keys(fact: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """Orphan keys with their row counts. Facts are reduced to one row per key before they meet the master."""
    return fact.groupBy(key).agg(F.count("*").alias("Row_Count")).join(master.select(key), key, "left_anti")


# --- coverage ----------------------------------------------------------------------------------------------------


def coverage(df: DataFrame, month: str) -> DataFrame:
    """One row: number of distinct months, the first and the last one."""
    return df.agg(
        F.count_distinct(month).alias("Distinct_Months"),
        F.min(month).alias("Earliest_Month"),
        F.max(month).alias("Latest_Month"),
    )


def incomplete_history(df: DataFrame, keys: Sequence[str], month: str, months: int) -> DataFrame:
    """Keys seen in a number of distinct months other than ``months``. A key without any row cannot appear."""
    return (
        df.groupBy(*keys)
        .agg(F.count_distinct(month).alias("Distinct_Demand_Month"))
        .filter(F.col("Distinct_Demand_Month") != months)
    )


def status_distribution(supply: DataFrame) -> DataFrame:
    """Rows and units per supply status, NULL included, most frequent first."""
    return (
        supply.groupBy("Supply_Status")
        .agg(F.count("*").alias("Row_Count"), F.sum("Planned_Supply_Units").alias("Supply_Units"))
        .orderBy(F.desc("Row_Count"), "Supply_Status")
    )


def multi_site_materials(inventory: DataFrame) -> DataFrame:
    """Materials stocked at several sites; the projection has to be told how to treat them."""
    return (
        inventory.groupBy("Material_ID")
        .agg(F.count_distinct("Site_ID").alias("Site_Count"))
        .filter(F.col("Site_Count") > 1)
    )


# --- all checks of one table -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableChecks:
    """Which checks apply to a table."""

    keys: Sequence[str]
    required: Sequence[str] = ()
    rules: Sequence[Rule] = ()


def check_table(df: DataFrame, checks: TableChecks) -> DataFrame:
    """Key, missing-value and range checks as (Check_Name, Violations), from one scan and one shuffle.

    The aggregation by key, which the uniqueness check needs anyway, carries the other counters along.
    """
    flags = [(f"Null_{c}", F.col(c).isNull()) for c in checks.required]
    flags += [(rule.name, rule.violated) for rule in checks.rules]
    per_key = df.groupBy(*checks.keys).agg(
        F.count("*").alias("n"), *[F.count_if(condition).alias(f"f{i}") for i, (_, condition) in enumerate(flags)]
    )
    zero = F.lit(0)
    return unpivot(
        per_key,
        [
            ("Rows", F.coalesce(F.sum("n"), zero)),
            ("Duplicate_Keys", F.count_if(F.col("n") > 1)),
            *[(name, F.coalesce(F.sum(f"f{i}"), zero)) for i, (name, _) in enumerate(flags)],
        ],
    )


def label(df: DataFrame, **labels: str) -> DataFrame:
    """Prefix constant text columns."""
    return df.select(*[F.lit(text).alias(name) for name, text in labels.items()], "*")


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)
