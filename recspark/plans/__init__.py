"""Named queries over the test tables (``queries``) and DuckDB oracles (``oracle``)."""
