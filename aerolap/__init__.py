"""aerolap: airline on-time analytics as Spark DataFrame plans.

Layout:
  sources/    readers and writers (test tables, CSV, zip, key/value text, streams)
  functions/  scalar column functions (parsing, labels, packing)
  operators/  filters, aggregates, top-k, reshaping, itineraries
  plans/      the named jobs, the query registry and the DuckDB oracle text
  streaming/  Structured Streaming jobs and keyed upsert output
"""

__version__ = "0.1.0"
