"""loomtable: record curation, matching and analytics on PySpark DataFrames."""
