"""Which repositories and batches are done: state as tables, resume as anti-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from srcsieve.operators.joins import lookup_join


def skip_seen_repos(repos: DataFrame, seen: DataFrame, month: int) -> DataFrame:
    """Drop repositories attempted in this month's earlier runs."""
    done = seen.where(F.col("month_no") == month).select("repo_name")
    return repos.join(done, "repo_name", "left_anti")


def skip_repos_seen_in_other_months(repos: DataFrame, seen: DataFrame, month: int) -> DataFrame:
    """Drop repositories attempted in any other month."""
    done = seen.where(F.col("month_no") != month).select("repo_name")
    return repos.join(done, "repo_name", "left_anti")


def mark_seen(seen: DataFrame, attempted: DataFrame, transient: tuple[str, ...] = ()) -> DataFrame:
    """Add every attempted repository to the state ``(month_no, repo_name, n)``.

    ``attempted`` is ``(month_no, repo_name, outcome)``. Outcomes named in ``transient``
    are left out, so those repositories are tried again.
    """
    tried = attempted.where(~F.col("outcome").isin(*transient)) if transient else attempted
    added = tried.select("month_no", "repo_name", F.lit(1).cast("long").alias("n"))
    both = seen.select("month_no", "repo_name", "n").unionByName(added)
    return both.groupBy("month_no", "repo_name").agg(F.sum("n").cast("long").alias("n"))


def repos_in_batch(records: DataFrame) -> DataFrame:
    """Distinct non-empty repository names of a partial batch."""
    return records.select("repo_name").where(F.col("repo_name") != "").distinct()


def first_month_per_repo(records: DataFrame) -> DataFrame:
    """Keep each repository's records of its first month only."""
    first = records.groupBy("repo_name").agg(F.min("month_no").alias("_first"))
    return (
        lookup_join(records, first, ["repo_name"])
        .where(F.col("month_no") == F.col("_first"))
        .select(*records.columns)
    )


def skip_finished_batches(todo: DataFrame, manifest: DataFrame) -> DataFrame:
    """Batches with work left and the ``start_at`` stage of each.

    ``todo`` is ``(month_no, batch)``, ``manifest`` ``(month_no, batch, stage)``. A filtered
    batch is finished; a deduplicated one needs the filters only.
    """
    done = manifest.groupBy("month_no", "batch").agg(
        F.coalesce(F.bool_or(F.col("stage") == "filtered"), F.lit(False)).alias("_filtered"),
        F.coalesce(F.bool_or(F.col("stage") == "deduped"), F.lit(False)).alias("_deduped"),
    )
    joined = todo.join(done, ["month_no", "batch"], "left").where(~F.coalesce("_filtered", F.lit(False)))
    return joined.select(
        "month_no", "batch", F.when(F.col("_deduped"), "filter").otherwise("dedup").alias("start_at")
    )


def resume_partial_batch(done: DataFrame, new: DataFrame) -> DataFrame:
    """Records already written, and new ones of repositories not among them.

    Running it twice gives the same rows, whatever was written before a crash.
    """
    fresh = lookup_join(new, done.select("repo_name").distinct(), ["repo_name"], "left_anti")
    return done.unionByName(fresh.select(*done.columns))
