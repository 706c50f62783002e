"""Table readers, sinks and the row generator."""
