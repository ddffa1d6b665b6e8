"""Column expressions shared by the operators. All are built-in Spark expressions (no Python UDF)."""

from prefkit.functions.columns import (  # noqa: F401
    genre_list,
    java_remainder,
    safe_div,
    split_label,
    tab_line,
    timestamp_bucket,
)
