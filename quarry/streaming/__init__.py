"""Structured Streaming.

The reference pipeline is batch only (no stream, watermark or state).  The
one stage that naturally runs on arriving data is scoring: a fitted feature
pipeline and model are plain transformers, so they apply unchanged to a
streaming DataFrame.  Nothing here adds an operator.
"""

from quarry.streaming.score import score_stream  # noqa: F401
