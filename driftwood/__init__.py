"""driftwood: recommender training-data preparation on Spark DataFrames.

Layout
------
functions/  scalar ``Column`` builders (JSON fields, dates, ids, tags, vectors)
sources/    readers and writers (log text, positional CSV, content shards,
            word-vector text, partitioned sinks)
operators/  DataFrame -> DataFrame relational operators (filters, pairing,
            labelling, flattening, lookups, vector sums)
plans/      composed jobs (training rows, content refresh, content vectors,
            snapshot repair) and the stand-in inputs derived from the
            supplied tables

These are built from Spark SQL built-ins; there is no Python UDF and no RDD
code in any of their plans.  llm/ holds the corpus operators (optional).
"""

__all__ = ["functions", "sources", "operators", "plans", "session", "schemas"]
