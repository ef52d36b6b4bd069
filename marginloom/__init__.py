"""Weekly KPI tables and a channel profit-and-loss statement as Spark DataFrame functions."""
