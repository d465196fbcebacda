"""Sources and sinks: driver tables, fixture views, files and fitted state."""
