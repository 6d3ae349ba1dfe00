"""Operators of a training-data pipeline: scoring, scanning, search, filtering,
tokenising and deduplicating documents. Nothing else in the library imports
this subpackage."""
