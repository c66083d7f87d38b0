"""netcap: regulatory capital position analytics on Spark.

Four independent feeds (share capital, reserves, dividends payable,
deductions) are decoded into one event table and folded into an exact
decimal capital position per (fsp_id, sector, reporting_date), in batch
and with Structured Streaming. Every public function takes and returns
DataFrames; nothing collects data to the driver.
"""

from netcap.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
