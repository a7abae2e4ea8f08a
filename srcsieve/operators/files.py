"""File selection and the assembly of code records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from srcsieve.constants import EXCLUDED_EXTENSIONS, IGNORED_DIRS
from srcsieve.functions.text import file_suffix
from srcsieve.operators.joins import lookup_join, dimension
from srcsieve.operators.languages import detect_language
from srcsieve.schema import CODE_RECORD


def filter_ignored_dirs(files: DataFrame, dirs: tuple[str, ...] = IGNORED_DIRS) -> DataFrame:
    """Drop files with an ignored name as any part of their path below the repository."""
    parts = F.split("file_name", "/")
    return files.where(~F.arrays_overlap(parts, F.array(*[F.lit(d) for d in dirs])))


def filter_supported_extension(files: DataFrame, extensions: DataFrame) -> DataFrame:
    """Keep files whose lower-cased suffix is a supported token.

    Tokens keep their case, so one stored in upper case matches no file.
    """
    tokens = dimension(extensions.select(F.col("extension").alias("_ext")))
    return files.join(tokens, file_suffix("file_name") == F.col("_ext"), "left_semi")


def filter_excluded_extension(files: DataFrame, excluded: tuple[str, ...] = EXCLUDED_EXTENSIONS) -> DataFrame:
    """Drop files with an excluded suffix; a bare dotfile has none."""
    return files.where(~file_suffix("file_name").isin(*excluded))


def valid_code_files(
    files: DataFrame,
    extensions: DataFrame,
    excluded: tuple[str, ...] = EXCLUDED_EXTENSIONS,
    dirs: tuple[str, ...] = IGNORED_DIRS,
) -> DataFrame:
    """Files that pass every file rule."""
    return (
        files.transform(filter_ignored_dirs, dirs)
        .transform(filter_excluded_extension, excluded)
        .transform(filter_supported_extension, extensions)
    )


def file_counts(files: DataFrame) -> DataFrame:
    """Valid files per repository."""
    return files.groupBy("repo_name").agg(F.count(F.lit(1)).alias("file_count"))


def repo_file_count(files: DataFrame) -> DataFrame:
    """Add ``file_count``. Counts are looked up, so file texts are not shuffled for them."""
    return lookup_join(files, file_counts(files), ["repo_name"])


def describe_files(files: DataFrame, counts: DataFrame, meta: DataFrame, dim: DataFrame) -> DataFrame:
    """Add the attributes of its repository and its language to each file."""
    attributes = meta.join(counts, "repo_name").select(
        "repo_name", "description", "stars", "file_count", F.col("size").alias("size_kb"), "license"
    )
    return detect_language(lookup_join(files, attributes, ["repo_name"]), dim)


def assemble_code_records(contents: DataFrame, counts: DataFrame, meta: DataFrame, dim: DataFrame) -> DataFrame:
    """Files with text × repository attributes → nine-column records.

    ``counts`` comes from the valid files before any was found unreadable; files without
    text are skipped.
    """
    readable = contents.where(F.col("text").isNotNull()).select("repo_name", "file_name", "text")
    return describe_files(readable, counts, meta, dim).select(*CODE_RECORD.fieldNames())
