"""Context lake: medallion ingestion, quality, rollups and decision rules as Spark jobs.

Every public function takes DataFrames plus column names and returns a lazy
DataFrame (or a Column); nothing in the library collects to the driver.
"""

__version__ = "0.1.0"
