"""Table scans, derived input views and sinks."""
