"""Ladderline: distributed ingestion of semi-structured business reports on Spark.

Every public function takes and returns DataFrames (or Columns), holds no global session and never
brings data rows to the driver.
"""
