from .bronze import bronze_events, bronze_rows, dead_letters, discover_schema, project
from .landing import decode, hour_tasks, kafka_events, landing_lines, landing_path, read_landing, route, start_landing
from .registry import SchemaRegistry, widen
from .tables import current_table, ensure_schema, publish
from .versions import VersionedDir

__all__ = [
    "bronze_events", "bronze_rows", "dead_letters", "discover_schema", "project", "decode",
    "hour_tasks", "kafka_events", "landing_lines", "landing_path", "read_landing", "route", "start_landing", "SchemaRegistry", "widen", "current_table",
    "ensure_schema", "publish", "VersionedDir",
]
