"""Commerce analytics on PySpark: batches of raw order files in, audited marts and views out."""
