"""Table-level operators and layer plans for a retail lakehouse on Spark.

``sources``    reading, writing and deriving tables
``functions``  column builders (money, labels, dates, lookups)
``operators``  table-to-table operators (dedup, quarantine, upsert, ranking, ...)
``plans``      the bronze / silver / gold tables, KPIs, measures and the refresh run
``streaming``  incremental ingest driven by file discovery
"""
