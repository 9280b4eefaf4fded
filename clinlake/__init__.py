"""clinlake — a clinical lakehouse analytics engine built on PySpark DataFrames.

Layers:
  sources/    readers and writers (CSV, JDBC, Parquet, catalog tables) and the
              stand-in entity tables derived from the driver's parquet data
  functions/  Column -> Column helpers (identifier/gender normalization, date
              parsing, age bands, keyword labels, percentages)
  operators/  DataFrame -> DataFrame building blocks (dedup, cohort, per-key
              summaries, rates, data checks)
  plans/      the named datasets: Silver cleaning + clinical master, Gold
              analytic tables, ingestion steps and the whole medallion run
              (also as ``python -m clinlake run``), plus the registered queries
  oracle_sql  DuckDB SQL twins of the registered queries (verification only)

Every public function takes DataFrames (and explicit parameters) and returns a
lazy DataFrame; the caller owns the SparkSession and decides when to act.
"""

__version__ = "0.1.0"
