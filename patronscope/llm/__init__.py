"""Operators of a training-data pipeline: text quality, duplicates, licences, mixing, sharding and packing."""
