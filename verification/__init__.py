"""The operators applied to the driver's tables, and the same results stated in SQL."""
