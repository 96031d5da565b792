import pytest

from torquelake.plans import explore


@pytest.fixture
def numbers(spark):
    spark.range(1234).createOrReplaceTempView("numbers")
    return "numbers"


@pytest.mark.parametrize("sql", ["select 1 AS one", "  SELECT 1 AS one", "SeLeCt 1 AS one"])
def test_select_is_let_through(spark, sql):
    assert explore.run_select(spark, sql).rows[0].one == 1


@pytest.mark.parametrize("sql", ["DROP TABLE x", "WITH a AS (SELECT 1) SELECT * FROM a", "", "INSERT INTO t SELECT 1"])
def test_anything_else_is_refused(spark, sql):
    with pytest.raises(ValueError, match="Only SELECT"):
        explore.run_select(spark, sql)


def test_long_result_is_cut_and_counted(spark, numbers):
    result = explore.run_select(spark, f"SELECT id FROM {numbers} ORDER BY id")
    assert [row.id for row in result.rows] == list(range(10))
    assert (result.row_count, result.truncated) == (1234, True)
    assert result.text() == "id\n" + "-" * 50 + "\n" + "\n".join(map(str, range(10))) + "\n\n... and 1224 more rows"


def test_record_holds_fifty_rows(spark, numbers):
    record = explore.run_select(spark, f"SELECT id FROM {numbers} ORDER BY id", explore.ROWS_IN_RECORD).record()
    assert record["columns"] == ["id"]
    assert (record["row_count"], len(record["rows"]), record["truncated"]) == (1234, 50, True)


def test_short_result_is_whole(spark, numbers):
    result = explore.run_select(spark, f"SELECT id, CAST(NULL AS INT) AS n FROM {numbers} WHERE id < 2 ORDER BY id")
    assert (result.row_count, result.truncated) == (2, False)
    assert result.text().endswith("0 | None\n1 | None")


def test_empty_result(spark, numbers):
    assert explore.run_select(spark, f"SELECT id FROM {numbers} WHERE id < 0").text() == "Query returned no results."


def test_preview_cuts_cells(spark):
    frame = spark.createDataFrame([("x" * 30, None)], "a string, b int")
    assert tuple(explore.preview(frame).first()) == ("x" * 20, "None")
    assert explore.preview_lines(frame).first().line == "x" * 20 + " | None"


def test_preview_shows_five_rows(spark, numbers):
    assert explore.preview(spark.table(numbers)).count() == 5


def test_schemas_tables_and_counts(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS looked_at LOCATION '{tmp_path}/looked_at'")
    for i in range(3):
        spark.range(1234).write.mode("overwrite").saveAsTable(f"looked_at.t{i}")
    assert "looked_at" in {row.namespace for row in explore.list_schemas(spark).collect()}
    assert [row.tableName for row in explore.list_tables(spark, "looked_at").collect()] == ["t0", "t1", "t2"]
    assert explore.list_tables(spark, "looked_at", 2).count() == 2
    assert explore.count_table(spark, "looked_at.t0").first().message == "📊 Table `looked_at.t0` has *1,234* rows"
    assert explore.count_table(spark, "t0").first().message == "📊 Table `looked_at.t0` has *1,234* rows"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS looked_at_too LOCATION '{tmp_path}/looked_at_too'")
    spark.range(1).write.mode("overwrite").saveAsTable("looked_at_too.t0")
    for name in ("t0", "nowhere"):  # in two schemas, in none
        with pytest.raises(ValueError, match="schema.table"):
            explore.count_table(spark, name)
