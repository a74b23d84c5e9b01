"""Scores of all meters: the one road that single queries and the full run take."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.operators import fraud
from wattledger.plans.sizing import MAX_BROADCAST_ROWS, fits_broadcast
from wattledger.plans.storage import Write, written

MAX_DISTRICTS = MAX_BROADCAST_ROWS // 10  # rows with a string key and three numbers
METERS_PER_KEY = 1_000_000


def meter_scores(sums: DataFrame, folder: str, max_districts: int = MAX_DISTRICTS, write: Write = written) -> tuple[DataFrame, DataFrame]:
    """(statistics per district, scored meters) from energy per meter and district; totals and statistics are written.

    The statistics are broadcast as they are if there are at most ``max_districts`` of them, so that the totals are not
    shuffled again. Beyond that both sides are joined on the district and a salt, with so many salts that a district
    with all meters still spreads over tasks of a million.
    """
    totals = write(fraud.one_district_per_meter(sums), f"{folder}/meter_totals")
    stats = write(fraud.district_stats(totals), f"{folder}/district_stats")
    if fits_broadcast(stats, max_districts):
        return stats, fraud.meter_zscores(totals, F.broadcast(fraud.valid_district_stats(stats)))
    return stats, fraud.meter_zscores(totals, stats, salts=max(16, totals.count() // METERS_PER_KEY))
