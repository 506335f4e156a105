"""casestar: case reports -> analysis-ready star schema, on Spark DataFrames.

Every public function is lazy: it takes and returns ``DataFrame`` or
``Column`` objects built from ``pyspark.sql.functions`` only, so Catalyst
sees the whole plan and no Python runs per row.
"""

__version__ = "0.1.0"
