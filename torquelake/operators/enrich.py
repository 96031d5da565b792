"""Event enrichment with car, model and color, and the expected gear."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torquelake.config import Settings
from torquelake.functions.scalars import expected_gear
from torquelake.operators.dimension import Dimension, measured
from torquelake.operators.joins import left_join_dimension
from torquelake.schemas import ENRICHED_SCHEMA


def car_profile(cars: DataFrame, models: Dimension, colors: Dimension, settings: Settings) -> DataFrame:
    """One row per car with its model and color names.

    Flattening on the car side, which is small next to the events, leaves one join on the
    event side instead of three.
    """
    named = left_join_dimension(cars.select("car_id", "driver_id", "model_id", "color_id"), models, settings)
    return left_join_dimension(named, colors, settings).select(
        "car_id",
        "driver_id",
        F.col("car_brand").alias("brand_name"),
        F.col("car_model").alias("model_name"),
        "color_name",
    )


def car_dimension(cars: DataFrame, models: Dimension, colors: Dimension, settings: Settings) -> Dimension:
    """The measured car profile; measured once, when the dimensions are loaded."""
    return measured(car_profile(cars, models, colors, settings), "car_id")


def enrich_events(events: DataFrame, profile: Dimension, settings: Settings) -> DataFrame:
    """What ``enrich`` gives, for questions that need no attribute of the car: without these columns.

    A profile whose measured keys are unique changes neither the events nor their number, so they
    are not joined. With repeated keys, or unmeasured ones, events are joined to the keys alone.
    """
    own = [name for name in ENRICHED_SCHEMA.fieldNames() if name in events.columns]
    rows = events if profile.unique else left_join_dimension(events, profile.keys_only(), settings)
    return rows.select(*own, expected_gear(F.col("speed"), settings.rules.speed_per_gear).alias("expected_gear"))


def enrich(events: DataFrame, profile: Dimension, settings: Settings) -> DataFrame:
    """Events with their car's attributes; an unknown car keeps its event, without them."""
    return (
        left_join_dimension(events, profile, settings)
        .withColumn("expected_gear", expected_gear(F.col("speed"), settings.rules.speed_per_gear))
        .select(*ENRICHED_SCHEMA.fieldNames())
    )
