"""Tables of a Spark catalog: the session's own, or any table catalog that is configured."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.sources import listing


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class CatalogDatabase:
    """One database of a catalog; without a ``catalog``, of the session's current one."""

    spark: SparkSession
    database: str
    catalog: str | None = None

    @property
    def name(self) -> str:
        """The database's name as statements have it; a nested one is given with dots."""
        parts = [*([self.catalog] if self.catalog else []), *self.database.split(".")]
        return ".".join(quoted(part) for part in parts)

    def list_tables(self) -> list[str]:
        """Names of the database's tables and views, in order; views of the session are not in it."""
        shown = self.spark.sql(f"SHOW TABLES IN {self.name}").where(~F.col("isTemporary"))
        return sorted(row["tableName"] for row in shown.select("tableName").collect())

    def read_table(self, table: str) -> DataFrame:
        """The whole table; filters and column choices made on it reach its scan."""
        return self.spark.table(f"{self.name}.{quoted(table)}")

    def declared_schema(self, table: str) -> list[tuple[str, str]]:
        """(column, type) in column order."""
        return listing.declared_schema(self.read_table(table))

    def table_counts(self) -> DataFrame:
        """(table_name, row_count) of every table."""
        return listing.count_tables(self.spark, self.list_tables(), self.read_table)

    def table_schemas(self, counted: bool = False) -> DataFrame:
        """(table_name, position, column_name, data_type) of every table, as of stored tables."""
        return listing.describe_tables(self.spark, self.list_tables(), self.read_table, counted)
