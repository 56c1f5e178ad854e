"""Rating tables built from survey answers (recommender inputs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pizarra.functions.scalar import round_half_even

# Fixed value: an unanswered survey question counts as the middle option.
MISSING_ANSWER = 3


def answers_filled(survey: DataFrame) -> DataFrame:
    """Null answer -> 3, then integer (``fillna(3).astype('int64')``)."""
    return survey.withColumn(
        "OPCION_ELEGIDA", F.coalesce(F.col("OPCION_ELEGIDA"), F.lit(float(MISSING_ANSWER))).cast("long")
    )


def ratings(survey: DataFrame, user: str = "IDNUMBER", digits: int = 2, name: str = "PUNTUACION") -> DataFrame:
    """Mean answer per (course, user), rounded half-even to ``digits``.

    ``digits=0`` gives integer ratings, as the neighbourhood model uses.
    """
    mean = answers_filled(survey).groupBy("CURID", user).agg(F.avg("OPCION_ELEGIDA").alias("_m"))
    r = round_half_even(F.col("_m"), digits)
    if digits == 0:
        r = r.cast("long")
    return mean.select("CURID", user, r.alias(name))
