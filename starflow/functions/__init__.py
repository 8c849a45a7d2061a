"""Pure Column builders (inventory X1-X24). No Python UDFs anywhere."""

from .buckets import AGE_BUCKETS, TEMPERATURE_BUCKETS, age_bucket, age_from_birth_year, bucketize, temperature_bucket
from .dates import date_columns, date_key, day_of_week0, from_day_number, iso_week, to_date_col
from .ids import random_id, stable_id
from .text import (blank_to_null, clean_number, default_code, join_or_unknown, norm_key, split_list,
                   split_location, split_once, strip_literal, unescape_html)

__all__ = [
    "AGE_BUCKETS", "TEMPERATURE_BUCKETS", "age_bucket", "age_from_birth_year", "bucketize", "temperature_bucket",
    "date_columns", "date_key", "day_of_week0", "from_day_number", "iso_week", "to_date_col",
    "random_id", "stable_id",
    "blank_to_null", "clean_number", "default_code", "join_or_unknown", "norm_key", "split_list",
    "split_location", "split_once", "strip_literal", "unescape_html",
]
