"""Repository discovery: from events to the repositories worth collecting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from srcsieve.constants import EVENT_TYPES, MAX_SIZE_KB, MIN_SIZE_KB, MIN_STARS
from srcsieve.operators.joins import dimension


def filter_event_types(events: DataFrame, types: tuple[str, ...] = EVENT_TYPES) -> DataFrame:
    """Keep events of the wanted kinds."""
    return events.where(F.col("type").isin(*types))


def latest_event_per_repo(events: DataFrame) -> DataFrame:
    """Distinct repositories with their greatest ``created_at``."""
    return events.groupBy("repo_name").agg(F.max("created_at").alias("created_at"))


def first_seen_order(events: DataFrame, position: list[str]) -> DataFrame:
    """Distinct repositories with the position of their first event.

    ``position`` columns order the events, such as archive hour and line. Later events do
    not move a repository.
    """
    first = F.min(F.struct(*position))
    return events.groupBy("repo_name").agg(first.alias("_first")).select(
        "repo_name", *[F.col(f"_first.{c}").alias(c) for c in position]
    )


def first_n_repos(events: DataFrame, position: list[str], max_repos: int) -> DataFrame:
    """The ``max_repos`` repositories seen first (a top-k, not a full sort)."""
    return first_seen_order(events, position).orderBy(*position, "repo_name").limit(max_repos)


def project_repo_metadata(raw: DataFrame) -> DataFrame:
    """Name the fields of a landed response.

    A missing licence becomes the text ``"null"``, a missing branch ``"main"``; a null
    description stays null.
    """
    licence = F.nullif(F.col("license.key"), F.lit(""))
    return raw.select(
        F.col("full_name").alias("repo_name"),
        "description",
        F.col("stargazers_count").alias("stars"),
        F.coalesce("default_branch", F.lit("main")).alias("default_branch"),
        F.coalesce(licence, F.lit("null")).alias("license"),
        "size",
        "language",
    )


def filter_min_stars(meta: DataFrame, min_stars: int = MIN_STARS) -> DataFrame:
    """Keep repositories with enough stars; an unknown count fails."""
    return meta.where(F.col("stars") >= min_stars)


def filter_repo_size(meta: DataFrame, low: int = MIN_SIZE_KB, high: int = MAX_SIZE_KB) -> DataFrame:
    """Keep repositories between two sizes in KB, both included."""
    return meta.where(F.col("size").between(low, high))


def filter_has_language(meta: DataFrame) -> DataFrame:
    """Keep repositories whose main language is known."""
    return meta.where(F.col("language").isNotNull())


def filter_supported_language(meta: DataFrame, languages: DataFrame) -> DataFrame:
    """Keep repositories whose main language is in ``languages``."""
    names = dimension(languages.select("language").distinct())
    return meta.join(names, "language", "left_semi").select(*meta.columns)


def select_repos(meta: DataFrame, languages: DataFrame) -> DataFrame:
    """Repositories that pass every repository rule."""
    return (
        meta.transform(filter_min_stars)
        .transform(filter_repo_size)
        .transform(filter_has_language)
        .transform(filter_supported_language, languages)
    )


def _reason(supported: Column) -> Column:
    return (
        F.when(~F.coalesce(F.col("stars") >= MIN_STARS, F.lit(False)), "insufficient stars")
        .when(~F.coalesce(F.col("size").between(MIN_SIZE_KB, MAX_SIZE_KB), F.lit(False)), "invalid size")
        .when(F.col("language").isNull(), "no language")
        .when(~supported, "unsupported language")
    )


def repo_reject_reason(meta: DataFrame, languages: DataFrame) -> DataFrame:
    """Add ``reason``: the first rule a repository fails, null if it is selected."""
    names = dimension(languages.select("language").distinct().withColumn("_known", F.lit(True)))
    joined = meta.join(names, "language", "left")
    supported = F.coalesce("_known", F.lit(False))
    return joined.select(*meta.columns, _reason(supported).alias("reason"))


def reject_counts(judged: DataFrame) -> DataFrame:
    """Repositories per reason."""
    return judged.groupBy("reason").agg(F.count(F.lit(1)).alias("repos"))
