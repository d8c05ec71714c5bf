"""mediasift: media-corpus curation as Spark DataFrame jobs.

Subpackages:
  sources    -- table loading, listings, sinks, derived test fixtures
  functions  -- Column-expression helpers (bits, vectors, text)
  operators  -- similarity joins, greedy leaders, labels, search, ...
  plans      -- end-to-end pipelines and the registered query set
  streaming  -- Structured Streaming jobs (incremental dedup, monitors)
"""

__version__ = "0.1.0"
