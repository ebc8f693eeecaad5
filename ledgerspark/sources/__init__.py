"""Where data comes from and goes to: xBase files, file listings, Parquet tables."""
