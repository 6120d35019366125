"""vigil: keyed vital-sign streams reconciled with daily lab files, on Spark.

Layout
------
``functions``  column expressions (rules, parsers, text builders)
``operators``  DataFrame -> DataFrame building blocks (decode, trends, as-of, audits)
``sources``    readers, writers and the keyed table store
``plans``      composed jobs (daily reconciliation, quality gate, serving frames)
``streaming``  Structured Streaming queries over the same operators
"""

__all__ = ["config", "schemas", "session"]
