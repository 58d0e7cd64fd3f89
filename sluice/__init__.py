"""sluice: configuration-driven batch and incremental ETL on Spark.

Every operator takes and returns DataFrames; Catalyst and AQE plan the work.
"""

from sluice.session import build_session, work_path

__all__ = ["build_session", "work_path"]
