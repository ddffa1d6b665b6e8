"""End-to-end plans: the registered queries over the test tables (``queries``), their DuckDB
equivalents (``oracle``), file-to-file jobs (``jobs``) and plan inspection (``inspect``)."""
