"""occurlens: a Spark-native pipeline for occurrence (theft report) analytics.

Every public function takes and returns DataFrames (or Columns) and stays
lazy; actions happen only in sinks and small reports.
"""

__version__ = "0.1.0"
