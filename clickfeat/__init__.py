"""clickfeat: sponsored-search click features and CTR models on Spark DataFrames.

Sub-packages:
  sources    readers for ads, users, click logs, counters, sentences, synonyms
  sinks      writers for the published tables (feature store, rewrites, models)
  functions  column-expression helpers (text cleaning, keys, seeded uniforms)
  operators  the data work: counters, enrichment joins, catalogue weights,
             neighbours, rewrites, weighted draws, negatives, models
  plans      end-to-end stage plans and the registered query catalogue
  streaming  Structured Streaming form of the click counters
"""

from clickfeat.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
