"""Multi-company ERP loading, reconciliation and integration on Spark DataFrames."""
