from snapfold.plans.analytics import (
    clubs_by_avg_age,
    clubs_with_contracts,
    filtered_top_n,
    group_avg_top_n,
    mode_per_period,
    most_popular_nationality,
    nationality_bars,
    nationality_histogram,
    unique_histogram,
)
from snapfold.plans.ingest import clean_and_cast, ingest, ingest_new

__all__ = [
    "clean_and_cast",
    "clubs_by_avg_age",
    "clubs_with_contracts",
    "filtered_top_n",
    "group_avg_top_n",
    "ingest",
    "ingest_new",
    "mode_per_period",
    "most_popular_nationality",
    "nationality_bars",
    "nationality_histogram",
    "unique_histogram",
]
