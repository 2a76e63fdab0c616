from rollwise.sources.sample import sample_params, sample_sources
from rollwise.sources.sinks import refresh_partitions, refreshed, scope, session_folder, stage, staging, write_durable
from rollwise.sources.tables import Sources, read_sources, schema_of

__all__ = [
    "Sources",
    "read_sources",
    "refresh_partitions",
    "refreshed",
    "sample_params",
    "sample_sources",
    "schema_of",
    "scope",
    "session_folder",
    "stage",
    "staging",
    "write_durable",
]
