"""JDBC tables.  Url, driver and credentials always come from the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

DEFAULT_BATCH_ROWS = 5000


@dataclass
class JdbcTables:
    spark: SparkSession
    url: str
    properties: dict[str, str] = field(default_factory=dict)

    def query(self, sql: str, alias: str = "q", split_by: str | None = None, bounds: tuple | None = None,
              partitions: int = 1) -> DataFrame:
        """Result of a subquery.  For large results give a numeric, date or timestamp column with its bounds: the
        read is then split over ``partitions`` connections instead of passing through a single one."""
        reader = self.spark.read.format("jdbc").option("url", self.url).option("dbtable", f"({sql}) {alias}")
        for key, value in self.properties.items():
            reader = reader.option(key, value)
        if split_by and bounds and partitions > 1:
            reader = (reader.option("partitionColumn", split_by).option("lowerBound", str(bounds[0]))
                      .option("upperBound", str(bounds[1])).option("numPartitions", str(partitions)))
        return reader.load()

    def existing_keys(self, table: str, key: str, **split) -> DataFrame:
        return self.query(f"SELECT {key} FROM {table}", "existing_keys", **split)

    def current_employees(self, table: str = "dim_employee", **split) -> DataFrame:
        return self.query(f"SELECT dim_employee_key, employee_id, email_id, is_current FROM {table} WHERE is_current = 1",
                          "e", **split)

    def dates(self, table: str = "dim_date") -> DataFrame:
        return self.query(f"SELECT dim_date_key, full_date FROM {table}", "d")

    def append(self, df: DataFrame, table: str, batch_rows: int = DEFAULT_BATCH_ROWS, connections: int | None = None) -> None:
        """Batched append over at most ``connections`` parallel connections."""
        rows = df.coalesce(connections) if connections else df
        rows.write.mode("append").option("batchsize", batch_rows).jdbc(self.url, table, properties=self.properties)

    def overwrite(self, df: DataFrame, table: str, batch_rows: int = DEFAULT_BATCH_ROWS) -> None:
        df.write.mode("overwrite").option("batchsize", batch_rows).jdbc(self.url, table, properties=self.properties)

    def execute(self, *statements: str) -> None:
        """Run statements in one transaction on the driver's connection."""
        jvm = self.spark._jvm
        driver = self.properties.get("driver")
        if driver:
            jvm.java.lang.Class.forName(driver)
        props = jvm.java.util.Properties()
        for key, value in self.properties.items():
            props.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, props)
        try:
            connection.setAutoCommit(False)
            for sql in statements:
                statement = connection.createStatement()
                statement.executeUpdate(sql)
                statement.close()
            connection.commit()
        finally:
            connection.close()

    def replace_dates(self, df: DataFrame, table: str, date_col: str) -> None:
        """Delete-insert by date.  The batch goes to a staging table in parallel; deleting the batch's dates and inserting the
        batch are then one transaction inside the database, so no key list passes through the driver."""
        staging = f"{table}_staging"
        self.overwrite(df, staging)
        self.execute(*replace_dates_sql(table, staging, date_col, df.columns))

    def insert_absent(self, df: DataFrame, table: str, key: str) -> None:
        """Insert the rows whose key the table lacks: the batch goes to a staging table in parallel and is compared inside the
        database, so the table's keys are not read through a connection."""
        staging = f"{table}_staging"
        self.overwrite(df, staging)
        self.execute(insert_absent_sql(table, staging, key, df.columns))

    def sync_dimension(self, versions: DataFrame, table: str, key: str, surrogate: str) -> None:
        """Bring a served type-2 dimension up to the lake's: expire current versions that are closed there, insert new ones."""
        staging = f"{table}_staging"
        self.overwrite(versions, staging)
        self.execute(*sync_dimension_sql(table, staging, key, surrogate, versions.columns))


def insert_absent_sql(table: str, staging: str, key: str, columns) -> str:
    names = ", ".join(columns)
    return (f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} s "
            f"WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE t.{key} = s.{key})")


def sync_dimension_sql(table: str, staging: str, key: str, surrogate: str, columns) -> tuple[str, str]:
    """Expire by surrogate key what is current in the table and closed, or replaced by another current version, in the staging
    table; then insert the versions the table lacks."""
    closed = f"SELECT 1 FROM {staging} s WHERE s.{key} = {table}.{key} AND s.is_current = 1 AND s.{surrogate} <> {table}.{surrogate}"
    since = f"(SELECT MIN(s.valid_from) FROM {staging} s WHERE s.{key} = {table}.{key} AND s.is_current = 1)"
    return (f"UPDATE {table} SET is_current = 0, valid_to = {since} WHERE is_current = 1 AND EXISTS ({closed})",
            insert_absent_sql(table, staging, surrogate, columns))


def replace_dates_sql(table: str, staging: str, date_col: str, columns) -> tuple[str, str]:
    names = ", ".join(columns)
    return (f"DELETE FROM {table} WHERE {date_col} IN (SELECT DISTINCT {date_col} FROM {staging})",
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}")
