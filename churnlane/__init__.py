"""churnlane: feature pipelines and model scoring on PySpark DataFrames."""

__version__ = "0.1.0"
