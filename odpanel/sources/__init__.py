"""Sources and sinks: driver tables, derived panels, CSV, record files, grids."""
