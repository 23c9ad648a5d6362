"""spark_ledger — household-finance ETL and reporting, written as Spark jobs.

Layers:
  functions/  column expressions (money, text, dates, flags, hashing)
  sources/    readers, vendor normalizers, sinks, fixture tables
  operators/  DataFrame -> DataFrame transforms (identity, upsert, rules,
              rollups, allocation, calendar, budget, projection, tax, measures)
  plans/      report queries and the query registry used by the driver
  streaming/  incremental (availableNow) loading through foreachBatch
"""

from spark_ledger.session import get_spark, checkpoint_dir, materialize  # noqa: F401
