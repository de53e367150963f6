"""tabforge: imbalanced binary classification on wide tables, built from
Spark DataFrame operators and ``pyspark.ml`` estimators.

Layout
------
``sources``    scans, sinks and the ingest job (SRC*, SNK*, ING1)
``functions``  column expressions: hashing, fills, number-to-text (SCL*)
``operators``  relational and ML operators (PRJ*, AGG*, SMP*, FEA*, MET*, LRN*, TUN*, EXP*)
``plans``      fixtures derived from the input tables, the query registry, end-to-end jobs
``streaming``  intentionally empty: the surveyed workload has no stream operator
"""

__version__ = "0.1.0"
