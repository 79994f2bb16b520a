"""Reports: each takes a mapping of table name to DataFrame, plus parameters."""
