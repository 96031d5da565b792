"""JSON payloads of topics: text to columns and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def parse_payload(messages: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the JSON in ``value``. What cannot be read becomes NULL; no row is lost.

    The one parsed struct is unfolded by a generator. Filters on its fields then stay above
    the parsing; pushed below a projection, each would parse the text once more per field.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(F.inline(F.array(parsed)))


def corrupt_payloads(messages: DataFrame, schema: StructType) -> DataFrame:
    """The messages that are no JSON of this schema, for a side output. An empty one is none either."""
    probe = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    text = F.col("value").cast("string")
    return (
        messages.select(text.alias("json_data"))
        .withColumn("parsed", F.from_json("json_data", probe, {"columnNameOfCorruptRecord": CORRUPT}))
        .filter(F.col("parsed").isNull() | F.col(f"parsed.{CORRUPT}").isNotNull())
        .select("json_data")
    )


def to_payload(frame: DataFrame) -> DataFrame:
    """One JSON ``value`` per row. NULL fields are left out, times are cut to milliseconds."""
    return frame.select(F.to_json(F.struct("*")).alias("value"))


def raw_capture(messages: DataFrame) -> DataFrame:
    """Audit rows: the payload as text, with a new id and the time of the (micro-)batch."""
    return messages.selectExpr(
        "uuid() AS id", "CAST(value AS STRING) AS json_data", "current_timestamp() AS timestamp"
    )
