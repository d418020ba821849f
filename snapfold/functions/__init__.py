from snapfold.functions.cleaning import (
    lenient_date,
    null_tokens,
    safe_double,
    safe_int,
    strip_modifier,
)
from snapfold.functions.hashing import hash32, hash_bucket

__all__ = [
    "hash32",
    "hash_bucket",
    "lenient_date",
    "null_tokens",
    "safe_double",
    "safe_int",
    "strip_modifier",
]
