"""Sources and sinks: driver tables, adapters, feeds, topic files, tables."""
