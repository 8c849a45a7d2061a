"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage; it may import the
library's general helpers. ``registry`` holds the queries and SQL twins that
``__spark_entry__.py`` adds when the subpackage is present.
"""
