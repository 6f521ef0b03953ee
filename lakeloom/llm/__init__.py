"""Operators for large training-data pipelines; nothing else in lakeloom imports this subpackage."""
