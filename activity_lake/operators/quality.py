"""Data-quality suites: every expectation about single rows is counted in one pass over the table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_lake.operators.joins import orphan_keys
from activity_lake.schemas import Table

# Fixed values in this module: the names of the expectations and the marks of the report.

_RESULT = (
    "expectation", "column_name", "parameters", "element_count", "missing_count", "unexpected_count",
)


@dataclass(frozen=True)
class Between:
    """Values within bounds, both inclusive; either may be open."""

    column: str
    min_value: float | None = None
    max_value: float | None = None
    name = "expect_column_values_to_be_between"

    @property
    def parameters(self) -> str:
        return f"min_value={self.min_value}, max_value={self.max_value}"

    def unexpected(self) -> Column:
        value = F.col(self.column)
        outside = F.lit(False)
        if self.min_value is not None:
            outside = outside | (value < self.min_value)
        if self.max_value is not None:
            outside = outside | (value > self.max_value)
        return outside


@dataclass(frozen=True)
class InSet:
    """Values among those listed."""

    column: str
    values: tuple
    name = "expect_column_values_to_be_in_set"

    @property
    def parameters(self) -> str:
        return "value_set=" + "|".join(str(value) for value in self.values)

    def unexpected(self) -> Column:
        # A NULL in the list would make the comparison NULL for every other value.
        listed = [value for value in self.values if value is not None]
        return F.col(self.column).isNotNull() & ~F.col(self.column).isin(*listed)


@dataclass(frozen=True)
class NotNull:
    """No missing values; here a missing value is also the unexpected one."""

    column: str
    name = "expect_column_values_to_not_be_null"
    parameters = ""

    def unexpected(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Unique:
    """No two rows share the key. Unexpected are the rows whose key another row has too."""

    columns: tuple[str, ...]
    name = "expect_compound_columns_to_be_unique"
    parameters = ""

    @property
    def column(self) -> str:
        return ",".join(self.columns)

    def key_counts(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("_rows"))

    def of_counts(self, counts: DataFrame) -> DataFrame:
        complete = reduce(lambda left, right: left & right, [F.col(column).isNotNull() for column in self.columns])
        copies = F.col("_rows")
        return counts.agg(
            _total(copies).alias("element_count"),
            _total(F.when(~complete, copies)).alias("missing_count"),
            _total(F.when(complete & (copies > 1), copies)).alias("unexpected_count"),
        )

    def result(self, rows: DataFrame) -> DataFrame:
        return self.of_counts(self.key_counts(rows))


@dataclass(frozen=True)
class References:
    """Every given key has a parent row."""

    column: str
    parents: DataFrame
    parent_key: str
    parent_name: str = "parent"
    name = "expect_column_values_to_have_parent"

    @property
    def parameters(self) -> str:
        return f"parent={self.parent_name}.{self.parent_key}"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,)

    def key_counts(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(self.column).agg(F.count(F.lit(1)).alias("_rows"))

    def of_counts(self, counts: DataFrame) -> DataFrame:
        known = self.parents.select(F.col(self.parent_key).alias(self.column)).distinct().withColumn("_known", F.lit(True))
        missing = F.col(self.column).isNull()
        return counts.join(known, self.column, "left").agg(
            _total(F.col("_rows")).alias("element_count"),
            _total(F.when(missing, F.col("_rows"))).alias("missing_count"),
            _total(F.when(~missing & F.col("_known").isNull(), F.col("_rows"))).alias("unexpected_count"),
        )

    def result(self, rows: DataFrame) -> DataFrame:
        return self.of_counts(self.key_counts(rows))


def _total(count: Column) -> Column:
    return F.coalesce(F.sum(count), F.lit(0))


def _label(counts: DataFrame, expectation) -> DataFrame:
    return counts.select(
        F.lit(expectation.name).alias("expectation"), F.lit(expectation.column).alias("column_name"),
        F.lit(expectation.parameters).alias("parameters"), "element_count", "missing_count", "unexpected_count",
    )


def _row_results(rows: DataFrame, expectations: Sequence) -> DataFrame:
    """Results of all expectations about single rows, from one aggregate."""
    counts = [F.count(F.lit(1)).alias("_rows")]
    for index, expectation in enumerate(expectations):
        counts += [
            F.count_if(F.col(expectation.column).isNull()).alias(f"_missing_{index}"),
            F.count_if(expectation.unexpected()).alias(f"_unexpected_{index}"),
        ]
    results = [
        F.struct(
            F.lit(expectation.name).alias("expectation"), F.lit(expectation.column).alias("column_name"),
            F.lit(expectation.parameters).alias("parameters"), F.col("_rows").alias("element_count"),
            F.col(f"_missing_{index}").alias("missing_count"), F.col(f"_unexpected_{index}").alias("unexpected_count"),
        )
        for index, expectation in enumerate(expectations)
    ]
    return rows.agg(*counts).select(F.inline(F.array(*results)))


def run_suite(rows: DataFrame, expectations: Sequence, suite: str = "suite") -> DataFrame:
    """One row per expectation. NULLs are reported as missing, and the percentage is of the rows that have a value."""
    by_row = [expectation for expectation in expectations if hasattr(expectation, "unexpected")]
    parts = [_row_results(rows, by_row)] if by_row else []
    parts += [_label(item.result(rows), item) for item in expectations if not hasattr(item, "unexpected")]
    return judged(reduce(DataFrame.unionByName, parts).select(*_RESULT), suite)


def judged(results: DataFrame, suite: str) -> DataFrame:
    """Counts of expectations with whether they are met and the percentage of unexpected values."""
    checked = F.when(
        F.col("expectation") == NotNull.name, F.col("element_count")
    ).otherwise(F.col("element_count") - F.col("missing_count"))
    return results.select(
        F.lit(suite).alias("suite"), "*",
        (F.col("unexpected_count") == 0).alias("success"),
        F.coalesce(F.try_divide(F.col("unexpected_count") * F.lit(100.0), checked), F.lit(0.0)).alias("unexpected_percent"),
    )


def suite_success(results: DataFrame) -> DataFrame:
    """One row per suite: whether every expectation was met."""
    return results.groupBy("suite").agg(
        F.every("success").alias("success"), F.count(F.lit(1)).alias("expectations"),
        F.count_if(~F.col("success")).alias("failed"),
    )


def with_report_line(results: DataFrame) -> DataFrame:
    """Results with a readable line each."""
    status = F.when(F.col("success"), "-- OK --").otherwise("-- KO --")
    detail = F.when(
        ~F.col("success"),
        F.format_string(" : %d/%d (%.1f%%)", "unexpected_count", "element_count", "unexpected_percent"),
    ).otherwise("")
    line = F.concat(status, F.lit(" ["), F.col("column_name"), F.lit("] "), F.col("expectation"), F.lit(" {"),
                    F.col("parameters"), F.lit("}"), detail)
    return results.withColumn("report_line", line)


def duplicate_keys(rows: DataFrame, *columns: str) -> DataFrame:
    """Keys that more than one row has, and how many."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def table_expectations(table: Table, parents: dict[str, DataFrame]) -> list:
    """Primary key, required columns and foreign keys of a declared table as expectations."""
    checks: list = [NotNull(column) for column in table.required]
    checks.append(Unique(table.primary_key))
    checks += [
        References(column, parents[parent], key, parent)
        for column, parent, key in table.foreign_keys if parent in parents
    ]
    return checks


def activity_expectations(sports: Sequence[str]) -> list:
    """The two checks of the activity table."""
    return [Between("distance", 0.01, None), InSet("type_pratique_sportive", tuple(sports))]


__all__ = [
    "Between", "InSet", "NotNull", "References", "Unique", "activity_expectations", "duplicate_keys", "orphan_keys",
    "run_suite", "suite_success", "table_expectations", "with_report_line",
]
