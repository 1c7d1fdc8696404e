"""panelforge: (entity, period) panel signals on Spark DataFrames.

Clean wide/long CSV, JSON matrix/payload and Parquet inputs with tolerant
typing; build dimensions and per-period facts; join them on entity and
period; derive lagged relative changes, period-demeaned changes and paired
signals; run data-quality checks and analytic extracts; ingest complaint
files incrementally with Structured Streaming.
"""

__version__ = "0.1.0"
