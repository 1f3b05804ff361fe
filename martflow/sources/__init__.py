"""Files, databases, records and web pages as DataFrames."""
