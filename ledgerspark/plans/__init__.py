"""Star schema, views, queries, series, checks and profiles as lazy DataFrames."""
