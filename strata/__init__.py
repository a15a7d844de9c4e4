"""strata: a PySpark library for medallion-style regulatory reporting.

Operators are functions from DataFrames to DataFrames: ingestion of file
drops (``sources``), rule validation, upserts, quality events, alerts and
marts (``operators``), column helpers (``functions``), query plans on the
driver tables (``plans``) and file-stream ingestion (``streaming``).
"""

__version__ = "0.1.0"
