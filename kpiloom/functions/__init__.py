"""Column functions: calendar, scalars, text rules."""
