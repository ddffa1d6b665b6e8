"""prefkit — preference analytics (users rating items with multi-valued categories) on Spark DataFrames.

Layout:
  schemas      column names and input StructTypes
  session      session defaults and the shared working folder (spark.checkpoint.dir)
  sources/     CSV readers, text-column parsing, survey responses, sinks, bindings to the test tables
  functions/   Column expressions (genre lists, timestamp buckets, split labels, safe division, row formatting)
  operators/   DataFrame -> DataFrame operators: items, aggregates, top-k, splits, matrix, similarity, ALS
  plans/       end-to-end jobs composed from operators, and physical-plan inspection helpers
  llm/         operators of a training-data pipeline over documents, pages and embeddings
"""

__version__ = "0.1.0"
