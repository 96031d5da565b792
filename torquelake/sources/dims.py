"""The built-in dimension rows: car models and car colors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from torquelake.operators.dimension import Dimension

# Model rows (model_id, car_brand, car_model).
CAR_MODELS = [
    (1, "Mazda", "3"),
    (2, "Mazda", "6"),
    (3, "Toyota", "Corolla"),
    (4, "Hyundai", "i20"),
    (5, "Kia", "Sportage"),
    (6, "Kia", "Rio"),
    (7, "Kia", "Picanto"),
]
# Color rows (color_id, color_name).
CAR_COLORS = [
    (1, "Black"),
    (2, "Red"),
    (3, "Gray"),
    (4, "White"),
    (5, "Green"),
    (6, "Blue"),
    (7, "Pink"),
]


def _inline(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """Rows as a VALUES list: Catalyst knows its size, which it does not for Python rows."""
    return spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, rows))} AS inline_rows({columns})")


def inline_models(spark: SparkSession) -> DataFrame:
    return _inline(spark, CAR_MODELS, "model_id, car_brand, car_model")


def inline_colors(spark: SparkSession) -> DataFrame:
    return _inline(spark, CAR_COLORS, "color_id, color_name")


def _inline_dimension(frame: DataFrame, key: str, rows: list[tuple]) -> Dimension:
    """A dimension whose size is known without measuring; the keys are unique."""
    sizes = [sum(len(str(value).encode()) for value in row) for row in rows]
    return Dimension(frame, key, len(rows), sum(sizes), max(sizes))


def model_dimension(spark: SparkSession) -> Dimension:
    return _inline_dimension(inline_models(spark), "model_id", CAR_MODELS)


def color_dimension(spark: SparkSession) -> Dimension:
    return _inline_dimension(inline_colors(spark), "color_id", CAR_COLORS)
