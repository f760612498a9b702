"""txlab: analysing and scoring highly imbalanced, labelled transaction tables on Spark.

Every capability is a function from DataFrame to DataFrame:

``sources``    readers, sinks, JSON artefacts, run table, generated rows
``functions``  column expressions (missing values, hashing, safe division, KS tail)
``operators``  single steps: validate, profile, split, resample, fit, measure, score, compare
``plans``      whole jobs composed of operators
``streaming``  the same scoring and drift work on Structured Streaming
``catalog``    the operators bound to the supplied tables, with their SQL counterparts
"""
