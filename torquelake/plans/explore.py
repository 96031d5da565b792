"""Looking around: schemas, tables, counts, previews, and guarded ad-hoc SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from torquelake.functions.scalars import CELL_SEPARATOR, MISSING, grouped_number, joined_cells, shown

# Bounds and texts of the ad-hoc views.
HIDDEN_SCHEMAS = ("information_schema",)
TABLES_SHOWN = 20
ROWS_SHOWN = 10
ROWS_IN_RECORD = 50
PREVIEW_ROWS = 5
PREVIEW_WIDTH = 20
RULER = "-" * 50


def list_schemas(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    where = f" IN {catalog}" if catalog else ""
    return spark.sql(f"SHOW NAMESPACES{where}").filter(~F.col("namespace").isin(*HIDDEN_SCHEMAS))


def list_tables(spark: SparkSession, schema: str, limit: int | None = None) -> DataFrame:
    """Stored tables of a schema; temporary views belong to none and are left out."""
    tables = spark.sql(f"SHOW TABLES IN {schema}").filter("NOT isTemporary").select("tableName")
    return tables if limit is None else tables.limit(limit)


def count_table(spark: SparkSession, name: str) -> DataFrame:
    """Rows of ``schema.table``; of a name alone if one schema has such a table, else it is refused."""
    if "." not in name:
        schemas = [row[0] for row in list_schemas(spark).collect()]
        found = [s for s in schemas if not list_tables(spark, s).filter(F.col("tableName") == name.lower()).isEmpty()]
        if len(found) != 1:
            raise ValueError("name the table as schema.table")
        name = f"{found[0]}.{name}"
    return count_text(spark.table(name), name)


def count_text(frame: DataFrame, name: str) -> DataFrame:
    counted = frame.agg(F.count("*").alias("num_of_rows"))
    text = F.concat(F.lit(f"📊 Table `{name}` has *"), grouped_number(F.col("num_of_rows")), F.lit("* rows"))
    return counted.withColumn("message", text)


def preview(frame: DataFrame, rows: int = PREVIEW_ROWS, order_by: list[str] | None = None) -> DataFrame:
    """The first rows as short texts; any rows, unless an order is given."""
    chosen = frame.orderBy(*order_by) if order_by else frame
    return chosen.limit(rows).select(*(shown(F.col(c), PREVIEW_WIDTH).alias(c) for c in frame.columns))


def preview_lines(frame: DataFrame, rows: int = PREVIEW_ROWS, order_by: list[str] | None = None) -> DataFrame:
    """The preview with the cells of a row joined to one line."""
    return preview(frame, rows, order_by).select(joined_cells(*frame.columns).alias("line"))


def select_only(sql: str) -> str:
    """The text itself if it is a SELECT; anything else is refused."""
    if not sql.strip().upper().startswith("SELECT"):
        raise ValueError("Only SELECT queries are allowed")
    return sql


@dataclass(frozen=True)
class SelectResult:
    """A bounded result: the first rows and the size of the whole."""

    columns: list[str]
    rows: list[Row]
    row_count: int

    @property
    def truncated(self) -> bool:
        return self.row_count > len(self.rows)

    def record(self) -> dict:
        return {
            "columns": self.columns,
            "row_count": self.row_count,
            "rows": [list(row) for row in self.rows],
            "truncated": self.truncated,
        }

    def text(self) -> str:
        if not self.rows:
            return "Query returned no results."
        lines = [CELL_SEPARATOR.join(self.columns), RULER]
        lines += [CELL_SEPARATOR.join(MISSING if v is None else str(v) for v in row) for row in self.rows]
        if self.truncated:
            lines.append(f"\n... and {self.row_count - len(self.rows)} more rows")
        return "\n".join(lines)


def run_select(spark: SparkSession, sql: str, max_rows: int = ROWS_SHOWN) -> SelectResult:
    """Run a SELECT and bring at most ``max_rows`` rows to the driver.

    One row more is fetched to see whether there are more; only then are all rows counted.
    """
    frame = spark.sql(select_only(sql))
    head = frame.take(max_rows + 1)
    row_count = len(head) if len(head) <= max_rows else frame.count()
    return SelectResult(frame.columns, head[:max_rows], row_count)


def select_bounded(spark: SparkSession, sql: str, max_rows: int = ROWS_SHOWN) -> DataFrame:
    """The first rows of a SELECT, each with the number of rows left out; the count is part of the plan."""
    frame = spark.sql(select_only(sql))
    left_out = F.greatest(F.count("*") - max_rows, F.lit(0)).alias("more_rows")
    counted = frame.agg(left_out).withColumn("_all", F.lit(1))
    head = frame.limit(max_rows).withColumn("_all", F.lit(1))
    return head.join(F.broadcast(counted), "_all").drop("_all")  # one row
