"""Column-level functions (no Python UDFs)."""

from paysight.functions.buckets import equal_width_bin, md5_bucket, md5_order_key
from paysight.functions.parse import age_to_double, years_to_double

__all__ = [
    "age_to_double",
    "equal_width_bin",
    "md5_bucket",
    "md5_order_key",
    "years_to_double",
]
