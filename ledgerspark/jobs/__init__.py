"""Jobs that write: loading raw tables, rebuilding the warehouse, the nightly run."""
