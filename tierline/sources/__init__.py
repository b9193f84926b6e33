"""Sources and sinks: contract CSV reads, versioned layer tables, catalog, test view."""
