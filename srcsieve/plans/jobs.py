"""Whole jobs: each is one plan over landed data, rather than a loop over files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from srcsieve.operators import discovery, files as file_ops, seen as state
from srcsieve.operators.fuzzy_dedup import deduplicate
from srcsieve.operators.joins import MAX_BROADCAST_ROWS, drop_ids, lookup_join
from srcsieve.operators.languages import language_distribution, relabel_language
from srcsieve.operators.near_index import add_to_index
from srcsieve.operators.notebooks import notebook_issues, process_notebooks
from srcsieve.operators.quality import filter_with_fallback
from srcsieve.schema import CODE_RECORD, JSON_OPTIONS
from srcsieve.session import materialise, read_runs
from srcsieve.sources.records import assign_output_batches, read_code_records, write_code_records, write_language_csv
from srcsieve.sources.tree import decode_text, list_source_files, read_file_contents


def discover_repos(
    events: DataFrame,
    raw_meta: DataFrame,
    seen: DataFrame,
    languages: DataFrame,
    month: int,
    max_repos: int | None = None,
) -> DataFrame:
    """Judge each newly active repository: metadata plus ``reason``, null if selected.

    ``max_repos`` stops after so many distinct repositories in order of their first event, then
    of their name. Repositories without a landed response are kept with the reason ``no metadata``.
    """
    events = discovery.filter_event_types(events)
    if max_repos is not None:
        events = events.join(discovery.first_n_repos(events, ["created_at"], max_repos), "repo_name", "left_semi")
    active = discovery.latest_event_per_repo(events)
    fresh = state.skip_seen_repos(active, seen, month)
    fresh = state.skip_repos_seen_in_other_months(fresh, seen, month).select("repo_name")
    meta = discovery.project_repo_metadata(raw_meta).withColumn("_landed", F.lit(True))
    judged = discovery.repo_reject_reason(fresh.join(meta, "repo_name", "left"), languages)
    reason = F.when(F.col("_landed").isNull(), "no metadata").otherwise(F.col("reason"))
    return judged.withColumn("reason", reason).drop("_landed")


def attempts(judged: DataFrame, month: int) -> DataFrame:
    """The state rows of judged repositories, for ``mark_seen``."""
    outcome = F.coalesce("reason", F.lit("collected"))
    return judged.select(F.lit(month).alias("month_no"), "repo_name", outcome.alias("outcome"))


def collect_records(
    meta: DataFrame,
    root: str,
    lang_dim: DataFrame,
    extensions: DataFrame,
    order: list[str] | None = None,
    next_batch: int = 0,
    unreadable: str | None = None,
) -> DataFrame:
    """Read the trees of selected repositories into numbered batches of records.

    ``unreadable`` names a folder for the log ``(repo_name, file_name, error)`` of files that
    could not be read, written as Parquet. Files are chosen from the listing, so unwanted ones are never opened; they are counted
    before any is found unreadable. They are described before they are read, so no join
    moves their texts.
    """
    listed = file_ops.valid_code_files(list_source_files(meta.select("repo_name"), root), extensions)
    chosen = materialise(listed, "listing")
    described = file_ops.describe_files(chosen.drop("length"), file_ops.file_counts(chosen), meta, lang_dim)
    names = CODE_RECORD.fieldNames()
    read = decode_text(read_file_contents(described, root, error="error")).select(*names, "error")
    landed = materialise(read, "records")
    if unreadable is not None:
        failed = landed.where(F.col("error").isNotNull())
        failed.select("repo_name", "file_name", "error").write.mode("overwrite").parquet(unreadable)
    records = landed.where(F.col("error").isNull()).select(*names)
    return assign_output_batches(records, order or ["repo_name"], next_batch)


def process_months(records: DataFrame, kernelspec: str = "top") -> DataFrame:
    """Notebook processing of all months in one narrow stage."""
    return process_notebooks(records, kernelspec)


def notebook_job(
    spark: SparkSession, source: str, target: str, partition_by: tuple[str, ...] = ("month",), kernelspec: str = "top"
) -> DataFrame:
    """Read record files below ``source``, turn notebooks into code, write every folder to ``target``.

    A folder that keeps no row is emptied there. Returns the log: one row per doubtful notebook.
    """
    records = _landed(spark, source, partition_by)
    folders = materialise(records.groupBy(*partition_by).agg(F.count("repo_name").alias("records")), "folders")
    write_code_records(process_months(records, kernelspec), target, partition_by, replace=folders)
    return notebook_issues(records, [*partition_by, "repo_name", "file_name"], kernelspec)


def relabel_job(
    spark: SparkSession, source: str, target: str, lang_dim: DataFrame, partition_by: tuple[str, ...] = ("month",)
) -> None:
    """Write the records below ``source`` to ``target`` with the language of their file name."""
    write_code_records(relabel_language(_landed(spark, source, partition_by), lang_dim), target, partition_by)


def language_report_job(spark: SparkSession, source: str, report: str, lang_dim: DataFrame) -> None:
    """Write how many files below ``source`` each language has."""
    write_language_csv(language_distribution(_landed(spark, source, ()), lang_dim), report)


def _landed(spark: SparkSession, source: str, partition_by: tuple[str, ...]) -> DataFrame:
    names = [f.name for f in CODE_RECORD if f.name not in partition_by]
    return read_code_records(spark, source).select(*names, *[F.col(c).cast("string").alias(c) for c in partition_by])


def curate(records: DataFrame, scope: str = "global", fallback_scope: tuple[str, ...] = ()) -> DataFrame:
    """Deduplicate, then filter by quality."""
    return filter_with_fallback(deduplicate(records, scope), fallback_scope)


def curate_run(
    records: DataFrame, index: str, run: int, filtered_path: str, partition_by: tuple[str, ...] = ("month",)
) -> None:
    """Curate the records of one run, such as a month, against all runs before, and write its folders.

    Only the run's own texts are read. Earlier records that turn out to be copies of a record with a smaller id
    are not rewritten: their ids go to the index, and ``curated_records`` leaves them out. The last run may
    be done again.
    """
    update = add_to_index(records, index, run)
    folders = materialise(records.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("records")), "folders")
    write_code_records(filter_with_fallback(update.kept), filtered_path, partition_by, replace=folders)
    update.retracted.write.mode("overwrite").parquet(f"{index}/retracted/run={run}")


def curated_records(stored: DataFrame, index: str) -> DataFrame:
    """``stored`` records of all runs of ``curate_run`` without those that a later run retracted."""
    return drop_ids(stored, read_runs(stored.sparkSession, f"{index}/retracted", "my_id string"), "my_id")


def rows_of_batches(rows: DataFrame, work: DataFrame, keys: list[str], start_at: tuple[str, ...]) -> DataFrame:
    """``rows`` of the batches that ``work`` lists with one of the stages ``start_at``.

    The condition on ``work`` makes the list a pruning filter: a scan of ``rows`` by folders opens
    only those of its batches.
    """
    listed = work.where(F.col("start_at").isin(*start_at)).select(*keys)
    if work.count() > MAX_BROADCAST_ROWS:
        return lookup_join(rows, listed, keys, "left_semi")
    return rows.join(F.broadcast(listed), keys, "left_semi")


def curate_job(
    records: DataFrame,
    manifest: DataFrame,
    deduped_path: str,
    filtered_path: str,
    partition_by: tuple[str, ...] = ("month", "batch"),
) -> DataFrame:
    """Curate the batches that are not finished and write both stages.

    ``manifest`` is ``(month, batch, stage)``. A batch with only its deduplicated records is
    filtered from those. Only folders of such batches are read. A batch that is done again replaces what an earlier try left of it,
    also where no row is kept. Returns the manifest rows to add once both writes are done.
    """
    spark = records.sparkSession
    keys = list(partition_by)
    named = manifest.withColumnRenamed("month", "month_no")
    todo = records.select(F.col("month").alias("month_no"), "batch").distinct()
    work = state.skip_finished_batches(todo, named).withColumnRenamed("month_no", "month")
    work = materialise(work, "work")
    to_dedup = work.where(F.col("start_at") == "dedup").select(*keys)
    fresh = rows_of_batches(records, work, keys, ("dedup",))
    deduped = deduplicate(fresh, "batch")
    write_code_records(deduped, deduped_path, partition_by, replace=to_dedup)
    schema = deduped.schema
    stored = spark.read.schema(schema).options(**JSON_OPTIONS).json(deduped_path)
    pending = rows_of_batches(stored, work, keys, ("dedup", "filter"))
    filtered = filter_with_fallback(pending, tuple(keys))
    write_code_records(filtered, filtered_path, partition_by, replace=work.select(*keys))
    return work.select(*keys, F.explode(F.array(F.lit("deduped"), F.lit("filtered"))).alias("stage")).join(
        manifest, [*keys, "stage"], "left_anti"
    )
