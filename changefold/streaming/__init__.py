from .facts import fact_changes, log_version, split_outputs, start_quarantine, start_split, start_valid
from .ingest import drain_bronze, remember, start_bronze
from .references import References
from .scd1 import Scd1Target

__all__ = [
    "fact_changes", "log_version", "split_outputs", "start_quarantine", "start_split", "start_valid", "drain_bronze", "remember", "start_bronze",
    "References", "Scd1Target",
]
