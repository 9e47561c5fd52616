"""Topics, change logs, JDBC tables and lake tables as DataFrames."""
