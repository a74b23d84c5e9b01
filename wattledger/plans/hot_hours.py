"""Weather joined to rows of hours that are frequent on both sides.

An hour with n rows of facts and m of weather has n * m rows in the result, in one task if the hour is the join key. Such hours
are found by a count and split: their facts and their weather are cut into pieces, and each pair of pieces is a key of its
own. All other hours are joined as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger import constants as C
from wattledger.operators.supply import weather_factors_of_hour
from wattledger.plans.sizing import broadcast_within
from wattledger.plans.storage import written

ROWS_PER_KEY = 1_000_000  # of the result


def hot_hours(facts: DataFrame, weather: DataFrame, rows_per_key: int = ROWS_PER_KEY) -> DataFrame:
    """timestamp, fact_pieces and weather_pieces of the hours whose result has more than ``rows_per_key`` rows.

    Both sides are counted by hour before they meet. The side with few rows is not cut: pieces of the other one then bound the
    rows of a key; where both have many, pieces of both are as long as the root of the bound.
    """
    counted = [df.groupBy("timestamp").agg(F.count(F.lit(1)).alias(name)) for df, name in ((facts, "n"), (weather, "m"))]
    both = counted[0].join(counted[1], "timestamp").where(F.col("n") * F.col("m") > rows_per_key)
    root = max(1, int(rows_per_key**0.5))

    def pieces(own: str, other: str) -> Column:
        few = F.col(own) <= root
        bounded = F.when(F.col(other) <= root, F.ceil(F.col(own) * F.col(other) / F.lit(rows_per_key))).otherwise(F.ceil(F.col(own) / F.lit(root)))
        return F.when(few, F.lit(1)).otherwise(bounded).cast("int")

    return both.select("timestamp", pieces("n", "m").alias("fact_pieces"), pieces("m", "n").alias("weather_pieces"))


def enrich_split(facts: DataFrame, weather: DataFrame, folder: str, rows_per_key: int = ROWS_PER_KEY) -> DataFrame:
    """``supply.enrich_with_weather`` with hot hours split over several keys; the list of them is written to ``folder``.

    A hot hour has more rows in the result than ``rows_per_key``, so there are few against the result. Pieces are dealt by the
    content of a row. Each row of facts meets each row of weather of its hour once: facts of a piece are repeated for each piece
    of the weather, and the other way round.
    """
    hot = broadcast_within(written(hot_hours(facts, weather, rows_per_key), f"{folder}/hot_hours"))
    factors = weather_factors_of_hour(weather)

    def dealt(df: DataFrame, own: str, other: str, flag: Column) -> DataFrame:
        piece = F.pmod(F.xxhash64(*df.columns), F.coalesce(own, F.lit(1))).cast("int").alias(f"_{own}")
        every = F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)
        return df.join(hot, "timestamp", "left").select(*df.columns, flag, piece, F.explode(every).alias(f"_{other}"))

    keys = ["_fact_pieces", "_weather_pieces"]
    left = dealt(facts, "fact_pieces", "weather_pieces", F.col("fact_pieces").isNotNull().alias("_hot"))
    right = dealt(factors, "weather_pieces", "fact_pieces", F.lit(True).alias("_met"))
    joined = left.join(right, ["timestamp", *keys], "left")
    # a hot hour has weather, though a piece of it may have none
    joined = joined.where("NOT _hot OR _met").drop("_hot", "_met", *keys)
    return joined.fillna(C.MISSING_WEATHER)
