"""Explicit schemas; no reader in this package infers one."""

from pyspark.sql import types as T

CODE_RECORD = T.StructType(
    [
        T.StructField("repo_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("stars", T.LongType()),
        T.StructField("file_count", T.LongType()),
        T.StructField("size_kb", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("license", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

ARCHIVE_EVENT = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("repo", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("created_at", T.StringType()),
    ]
)

REPO_RESPONSE = T.StructType(
    [
        T.StructField("full_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("stargazers_count", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("license", T.StructType([T.StructField("key", T.StringType())])),
        T.StructField("default_branch", T.StringType()),
    ]
)

LANGUAGE_MAP = T.StructType(
    [
        T.StructField("pos", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("extensions", T.ArrayType(T.StringType())),
    ]
)

#: For every JSON read: no length, digit or depth limit of the parser loses a record.
JSON_OPTIONS = {"maxStringLen": "2147483647", "maxNumLen": "2147483647", "maxNestingDepth": "100000"}
