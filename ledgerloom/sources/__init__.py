"""Where rows come from and go to: parquet tables, work tables, XML items, delimited text."""
