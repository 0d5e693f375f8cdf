"""Time-series rollup, event select and table transfer on PySpark DataFrames."""
