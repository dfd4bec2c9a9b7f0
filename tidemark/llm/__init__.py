"""Operators of a training-data pipeline: formatting, tokens, language, packing, duplicates, filters."""
