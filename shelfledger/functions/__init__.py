"""Column expressions: calendar labels, classifications, measures, date horizons."""
