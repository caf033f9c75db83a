"""quarry: a PySpark-native Q&A corpus preparation and answered/unanswered
classification engine.

Layout
------
sources/    CSV / LibSVM / Parquet readers and writers, test-table role adapters
functions/  column expressions (casts, text, list formatting, tag segmentation)
operators/  DataFrame -> DataFrame stages (clean, tags, features, model, metrics)
plans/      end-to-end stage plans and the query registry used by __spark_entry__
streaming/  Structured Streaming scoring of a fitted model
"""

__version__ = "0.1.0"
