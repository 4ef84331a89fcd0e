from stayline.sources.events import (
    EVENT_SCHEMA,
    corrupt_lines,
    map_columns,
    preview,
    read_events,
    require_columns,
    schema_report,
)
from stayline.sources.sinks import write_table

__all__ = [
    "EVENT_SCHEMA",
    "corrupt_lines",
    "map_columns",
    "preview",
    "read_events",
    "require_columns",
    "schema_report",
    "write_table",
]
