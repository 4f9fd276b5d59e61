"""tillbook: retail analytics on PySpark DataFrames."""
