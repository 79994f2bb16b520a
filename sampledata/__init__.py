"""Retail-shaped views over the driver's tables, and the checked queries built on them."""
