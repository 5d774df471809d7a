"""Look at the first rows, raw or rendered."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from rowscribe.functions import fixed
from rowscribe.operators.order import head
from rowscribe.sources.datasets import load_split

RAW_ROWS = 5
FORMATTED_ROWS = 3


def preview_raw(df: DataFrame, order_by: Sequence[str], n: int = RAW_ROWS) -> DataFrame:
    return head(df, n, order_by)


def preview_formatted(df: DataFrame, order_by: Sequence[str], n: int = FORMATTED_ROWS) -> DataFrame:
    return head(df, n, order_by)


def preview_dataset(
    spark: SparkSession, name: str, order_by: Sequence[str], **load_options
) -> tuple[DataFrame, str]:
    """A preview and a status; on failure an empty table and the reason."""
    try:
        return preview_raw(load_split(spark, name, **load_options), order_by), fixed.PREVIEW_OK
    except Exception as error:
        return spark.createDataFrame([], "struct<>"), f"{fixed.PREVIEW_ERROR}{error}"
