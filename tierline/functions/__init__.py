"""Column expressions: date composition, report measures, report filters."""
