"""Sources and sinks: raw delimited files, written tables, versioned tables."""
