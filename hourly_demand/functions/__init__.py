"""Column expressions: calendar, time zones, errors and bounds."""
