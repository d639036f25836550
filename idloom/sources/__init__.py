"""Raw sources: a name -> (format, path) registry and the test-data adapters."""

from idloom.sources.registry import SOURCE_NAMES, SourceRegistry, read_driver_tables
from idloom.sources.adapters import ADAPTER_SQL, raw_sources, adapter_sql_for

__all__ = ["SOURCE_NAMES", "SourceRegistry", "read_driver_tables", "ADAPTER_SQL",
           "raw_sources", "adapter_sql_for"]
