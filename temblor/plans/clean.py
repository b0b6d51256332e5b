"""From raw records to the cleaned table that every batch query reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preprocess_quakes(df: DataFrame) -> DataFrame:
    """Normalise `state`, drop `data_type`, rename `magnitudo`.

    trim() removes spaces only, and a state of blanks becomes '' and not NULL.
    """
    return (
        df.withColumn("state", F.upper(F.trim("state")))
        .drop("data_type")
        .withColumnRenamed("magnitudo", "magnitude")
    )
