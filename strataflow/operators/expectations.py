"""Chained table expectations evaluated together in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


class Expectations:
    """Collects expectations; nothing runs until :meth:`report` is used.

    >>> Expectations(df).column_values_not_null("id").row_count_between(1, 10).report()
    """

    def __init__(self, df: DataFrame):
        self._df = df
        self._measures: dict[str, Column] = {}
        self._checks: list[tuple[str, Column, Column]] = []

    def _measure(self, name: str, aggregate: Column) -> Column:
        self._measures.setdefault(name, aggregate)
        return F.col(f"`{name}`")

    def _add(self, assertion: str, success: Column, details: Column | None = None) -> "Expectations":
        self._checks.append((assertion, success, F.lit("") if details is None else details))
        return self

    def _rows(self) -> Column:
        return self._measure("rows", F.count(F.lit(1)))

    def column_to_exist(self, column: str) -> "Expectations":
        return self._add(f"Column '{column}' exists", F.lit(column in self._df.columns))

    def column_values_not_null(self, column: str) -> "Expectations":
        if column not in self._df.columns:
            return self._add(f"Cannot check nulls for '{column}' - column missing", F.lit(False))
        nulls = self._measure(f"nulls:{column}", F.count_if(F.col(column).isNull()))
        return self._add(f"Column '{column}' is not null", nulls == 0, F.concat(F.lit("Null count: "), nulls))

    def column_values_unique(self, column: str) -> "Expectations":
        """Null counts as a value of its own."""
        if column not in self._df.columns:
            return self._add(f"Cannot check uniqueness for '{column}' - column missing", F.lit(False))
        total = self._rows()
        distinct = self._measure(f"distinct:{column}", F.count_distinct(F.struct(F.col(column))))
        return self._add(f"Column '{column}' values are unique", total == distinct,
                         F.concat(F.lit("Total: "), total, F.lit(", Distinct: "), distinct))

    def column_values_in_set(self, column: str, allowed) -> "Expectations":
        """Null rows pass."""
        if column not in self._df.columns:
            return self._add(f"Cannot check values for '{column}' - column missing", F.lit(False))
        bad = self._measure(f"outside:{column}:{allowed!r}", F.count_if(~F.col(column).isin(list(allowed))))
        return self._add(f"Column '{column}' values in {allowed}", bad == 0, F.concat(F.lit("Invalid count: "), bad))

    def row_count_between(self, low: int, high: int) -> "Expectations":
        rows = self._rows()
        return self._add(f"Row count between {low} and {high}", rows.between(low, high),
                         F.concat(F.lit("Actual count: "), rows))

    def report(self) -> DataFrame:
        """``(position, assertion, success, details)``, one row per expectation in the order added."""
        measures = self._measures or {"rows": F.count(F.lit(1))}
        numbers = self._df.agg(*[aggregate.alias(name) for name, aggregate in measures.items()])
        entries = [F.struct(F.lit(i).alias("position"), F.lit(assertion).alias("assertion"),
                            success.alias("success"), details.alias("details"))
                   for i, (assertion, success, details) in enumerate(self._checks)]
        return numbers.select(F.inline(F.array(*entries)))

    def get_report(self) -> dict:
        """The report on the driver: its size is the number of expectations."""
        rows = self.report().orderBy("position").collect()
        return {"passed": all(r.success for r in rows),
                "assertions": [{"assertion": r.assertion, "success": r.success, "details": r.details} for r in rows]}

    def assert_all(self) -> None:
        """Raise with the list of failed expectations."""
        failed = [a for a in self.get_report()["assertions"] if not a["success"]]
        if failed:
            lines = "".join(f"- {a['assertion']} ({a['details']})\n" for a in failed)
            raise AssertionError("Data Quality Checks Failed:\n" + lines)
