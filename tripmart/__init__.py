"""Trip analytics and master data on PySpark DataFrames."""
