"""Operators for training-data pipelines (dedup, decontamination, packing,
...). Nothing else in the library imports this subpackage."""
