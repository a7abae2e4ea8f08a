"""Language dimension: from a language dictionary to a language per file.

A dictionary is a DataFrame ``(pos, language, extensions array<string>)``; ``pos`` is the
place of the language in the source file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from srcsieve.constants import EXCLUDED_LANGUAGES, EXTRA_MIME_TYPES, UNKNOWN_LANGUAGE
from srcsieve.functions.text import file_suffix
from srcsieve.operators.joins import dimension


def read_language_map(spark: SparkSession, path: str) -> DataFrame:
    """Read a dictionary file: one JSON object from language to list of extensions."""
    whole = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "map<string, array<string>>")
    return whole.select(F.posexplode(parsed).alias("pos", "language", "extensions")).withColumn(
        "pos", F.col("pos").cast("long")
    )


def exclude_languages(lang_map: DataFrame, excluded: tuple[str, ...] = EXCLUDED_LANGUAGES) -> DataFrame:
    """Remove languages by exact name; names that are absent do nothing."""
    return lang_map.where(~F.col("language").isin(*excluded))


def extension_language_dim(lang_map: DataFrame) -> DataFrame:
    """One language per lower-cased extension; the last one in file order wins.

    Only tokens that start with a dot count, and a language may have no list at all.
    """
    tokens = lang_map.select("pos", "language", F.posexplode("extensions").alias("nth", "token"))
    return (
        tokens.where(F.startswith("token", F.lit(".")))
        .groupBy(F.lower("token").alias("extension"))
        .agg(F.max_by("language", F.struct("pos", "nth")).alias("language"))
    )


def supported_extensions(lang_map: DataFrame) -> DataFrame:
    """The distinct tokens as written: neither lower-cased nor limited to a dot."""
    return (
        lang_map.select(F.explode("extensions").alias("extension"))
        .where(F.col("extension").isNotNull())
        .distinct()
    )


def detect_language(df: DataFrame, dim: DataFrame, file_name: str = "file_name", name: str = "language") -> DataFrame:
    """Set ``name`` to the language of the file's extension, else ``Unknown``."""
    known = dimension(dim.select(F.col("extension").alias("_ext"), F.col("language").alias("_lang")))
    others = [c for c in df.columns if c != name]
    joined = df.join(known, file_suffix(file_name) == F.col("_ext"), "left")
    return joined.select(*others, F.coalesce("_lang", F.lit(UNKNOWN_LANGUAGE)).alias(name))


def relabel_language(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Overwrite the stored language of code records from their file name."""
    return detect_language(df, dim).select(*df.columns)


def language_distribution(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Files per detected language.

    Rows are counted per extension first, so the lookup meets one row per extension
    rather than one per file.
    """
    suffixes = df.groupBy(file_suffix("file_name").alias("_ext")).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col("extension").alias("_ext"), F.col("language").alias("_lang"))
    joined = suffixes.join(known, "_ext", "left")
    return joined.groupBy(F.coalesce("_lang", F.lit(UNKNOWN_LANGUAGE)).alias("Language")).agg(
        F.sum("n").cast("long").alias("Count")
    )


def mime_dim(spark: SparkSession, lexers: DataFrame) -> DataFrame:
    """Media type per lower-cased language: the first of each lexer, and the extras.

    ``lexers`` is ``(pos, name, mime_types array<string>)``. A later lexer of the same name
    wins, and an extra fills in only where no lexer gives a type.
    """
    listed = (
        lexers.where(F.size("mime_types") > 0)
        .groupBy(F.lower("name").alias("language"))
        .agg(F.max_by(F.col("mime_types")[0], "pos").alias("mime"))
    )
    extras = spark.createDataFrame(list(EXTRA_MIME_TYPES.items()), "language string, mime string")
    return listed.unionByName(extras.join(listed, "language", "left_anti"))


def language_mime(df: DataFrame, mimes: DataFrame) -> DataFrame:
    """Add ``mime``, null where the language has none."""
    known = dimension(mimes.select(F.col("language").alias("_lower"), "mime"))
    return df.join(known, F.lower("language") == F.col("_lower"), "left").drop("_lower")
