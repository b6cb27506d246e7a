"""Where rows live: parquet scans, keyed tables, attached sources and stored indexes."""
