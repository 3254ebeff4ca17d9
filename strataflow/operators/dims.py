"""Dimension lookups of facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.casts import join_key


def lookup(fact: DataFrame, dim: DataFrame, fact_key, dim_key, take: dict[str, str], how: str = "left",
           salts: int = 1) -> DataFrame:
    """Left join bringing the ``take`` columns (source to target name) of ``dim`` to the fact rows.

    No broadcast hint: adaptive execution broadcasts the dimension when its measured size is below the session
    threshold and otherwise splits skewed fact partitions.  ``salts`` > 1 spreads every fact key over that
    many partitions (at the price of as many copies of the dimension) for plans where the adaptive
    split does not apply.
    """
    side = dim.select(F.col(f"`{dim_key}`").alias("_dim_key") if isinstance(dim_key, str) else dim_key.alias("_dim_key"),
                      *[F.col(source).alias(target) for source, target in take.items()])
    key = F.col(f"`{fact_key}`") if isinstance(fact_key, str) else fact_key
    condition = key == F.col("_dim_key")
    if salts > 1:
        # The salt comes from the row itself, so a retried task sends each row to the same place.
        fact = fact.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.lit(salts)))
        side = side.withColumn("_dim_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        condition = condition & (F.col("_salt") == F.col("_dim_salt"))
    return fact.join(side, condition, how).drop("_dim_key", "_salt", "_dim_salt")


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current") == 1)


def enrich(fact: DataFrame, dim_employee: DataFrame, dim_date: DataFrame, employee_col: str | None = "employee_id",
           date_col: str | None = "work_date", email_col: str = "email", salts: int = 1) -> DataFrame:
    """Add ``dim_employee_key`` and ``dim_date_key``.

    Only current dimension rows count.  The employee is found by id, compared as text, or by e-mail when the fact
    has no id column; the choice is made when the plan is built.
    """
    people = current_rows(dim_employee)
    take = {"dim_employee_key": "dim_employee_key"}
    if employee_col and employee_col in fact.columns:
        fact = lookup(fact, people, join_key(F.col(employee_col)), join_key(F.col("employee_id")), take, salts=salts)
    elif email_col in fact.columns:
        fact = lookup(fact, people, email_col, "email_id", take, salts=salts)
    if date_col and date_col in fact.columns:
        fact = lookup(fact, dim_date, date_col, "full_date", {"dim_date_key": "dim_date_key"})
    return fact


def resolved(fact: DataFrame, key: str = "dim_employee_key") -> DataFrame:
    """Facts whose dimension key was found (Catalyst turns the outer lookup into an inner join)."""
    return fact.filter(F.col(key).isNotNull())


def rejects(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Facts with no current dimension row."""
    side = current_rows(dim).select(join_key(F.col(dim_key)).alias("_dim_key"))
    return fact.join(side, join_key(F.col(fact_key)) == F.col("_dim_key"), "left_anti")


def date_dimension(facts: DataFrame, date_col: str) -> DataFrame:
    """Calendar covering the dates of a table: ``dim_date_key`` (yyyyMMdd) and ``full_date``."""
    span = facts.agg(F.min(F.col(date_col).cast("date")).alias("lo"), F.max(F.col(date_col).cast("date")).alias("hi"))
    days = span.filter(F.col("lo").isNotNull()).select(
        F.explode(F.expr("sequence(lo, hi, interval 1 day)")).alias("full_date"))
    return days.select(F.date_format("full_date", "yyyyMMdd").cast("int").alias("dim_date_key"), "full_date")
