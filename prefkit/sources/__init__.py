"""Sources and sinks: CSV files, CSV text columns, survey responses, written tables, test-table bindings."""

from prefkit.sources.readers import (  # noqa: F401
    bad_item_lines,
    bad_rating_lines,
    parse_items,
    parse_ratings,
    preferences_from_responses,
    read_items,
    read_personal_ratings,
    read_ratings,
)
from prefkit.sources.sinks import read_table, write_table  # noqa: F401
