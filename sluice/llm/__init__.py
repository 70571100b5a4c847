"""Operators of a training-data pipeline: quality, WARC, near copies, licences, language, packing, sharding."""
