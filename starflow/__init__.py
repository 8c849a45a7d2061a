"""starflow: star-schema ETL and analytics on PySpark.

Layout
------
functions/   pure ``Column`` builders (dates, buckets, text cleaning, ids)
operators/   reusable DataFrame operators (group-first, lookups, quality checks)
sources/     typed scans and text/HTML extractors that run as Spark jobs
plans/       staging -> dimensions -> fact -> load -> star query compositions
streaming/   incremental (file-arrival) form of the fact build

Every operator is table-agnostic: it takes DataFrames and column names and
returns a lazily planned DataFrame, so Catalyst sees one plan end to end.
"""

__version__ = "0.1.0"
