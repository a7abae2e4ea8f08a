"""Spark-first curation of source-code corpora.

Every operator is a plain function ``f(df, ..., **params) -> DataFrame`` that can be
chained with ``DataFrame.transform``.
"""
