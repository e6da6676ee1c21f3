"""Governed file intake on Spark: typed loads, data-quality logs and current-state tables."""
