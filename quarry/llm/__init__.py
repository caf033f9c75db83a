"""Operators of a training-data pipeline: deduplication, filtering, PII,
decontamination, packing and archive formats, each as Spark jobs."""
