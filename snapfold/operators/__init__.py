from snapfold.operators.dedup import dedup_latest, unique_entities
from snapfold.operators.quantile import exact_median, impute_median
from snapfold.operators.ranking import frequency_index, global_index
from snapfold.operators.splitting import hash_split, with_fold
from snapfold.operators.topn import top_n, top_n_with_ties, top_per_group

__all__ = [
    "dedup_latest",
    "exact_median",
    "frequency_index",
    "global_index",
    "hash_split",
    "impute_median",
    "top_n",
    "top_n_with_ties",
    "top_per_group",
    "unique_entities",
    "with_fold",
]
