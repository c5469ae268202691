"""P2: rename every column to unique ``UPPER_SNAKE_CASE``."""

from pyspark.sql import DataFrame

from tidewater.functions.naming import normalized_names


def normalize_columns(df: DataFrame) -> DataFrame:
    """One ``Project`` with aliases; no data is touched."""
    return df.toDF(*normalized_names(df.columns))
