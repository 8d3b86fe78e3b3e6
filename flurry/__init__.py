"""flurry: DataFrame-in / DataFrame-out analytics operators on Spark.

Sub-packages
------------
sources    typed scans, catalog tables, JSON records, model artefacts
functions  column -> column helpers (URLs, vectors, struct flattening)
operators  table operators: cleaning, joins, summaries, windows, sampling,
           encoding, models, evaluation, explanations, vectors, pages,
           monitoring
plans      derived analysis tables and the registered query catalogue
streaming  Structured Streaming forms of scoring and late-truth monitoring
"""

__version__ = "0.1.0"
