"""A PySpark engine that turns captured pages and records about office-holders into clean, checked tables."""
