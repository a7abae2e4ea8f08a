"""Sources and sinks: each query writes the given tables in a landed form and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.discovery import DETECTED, VALID, _dim, _extensions
from checks.discovery import SQL as DISCOVERY_SQL
from checks.views import sql, view
from srcsieve.operators.languages import language_distribution
from srcsieve.plans import jobs
from srcsieve.schema import CODE_RECORD
from srcsieve.session import scratch_path
from srcsieve.sources import records as R
from srcsieve.sources.archive import read_archive_events
from srcsieve.sources.metadata import read_repo_metadata
from srcsieve.sources.tree import _open_root, decode_text, read_source_tree

Q: dict = {}
SQL: dict[str, str] = {}


def _event_line():
    """One archive line; some lack a field, and some are cut off."""
    line = F.to_json(
        F.struct(
            F.when(F.col("event_id") % 50 != 9, F.col("type")).alias("type"),
            F.when(F.col("event_id") % 50 != 11, F.struct(F.col("repo_name").alias("name"))).alias("repo"),
            "created_at",
        )
    )
    return F.when(F.col("event_id") % 50 == 7, F.substring(line, 1, 20)).otherwise(line)


def land_events(spark, sf, files: int = 6) -> str:
    """Archive files of all events, with broken and incomplete lines among them."""
    folder = scratch_path(spark, "archive")
    lines = view(spark, sf, "archive_events").repartition(files, "event_id").select(_event_line().alias("value"))
    lines.write.option("compression", "gzip").text(folder)
    return folder


INTACT = "event_id % 50 NOT IN (7, 9, 11)"
Q["read_archive_events"] = lambda spark, sf: read_archive_events(spark, land_events(spark, sf))
SQL["read_archive_events"] = sql(
    f"SELECT type, repo_name, created_at FROM archive_events WHERE {INTACT}", "archive_events"
)


def _read_metadata(spark, sf):
    folder = scratch_path(spark, "responses")
    raw = view(spark, sf, "repo_responses").withColumn(
        "license", F.when(F.col("license_key").isNotNull(), F.struct(F.col("license_key").alias("key")))
    )
    raw.drop("license_key").write.json(folder)
    return read_repo_metadata(spark, folder).withColumn("license", F.col("license.key"))


Q["read_repo_metadata"] = _read_metadata
SQL["read_repo_metadata"] = sql("SELECT * RENAME (license_key AS license) FROM repo_responses", "repo_responses")


def land_tree(spark, sf) -> tuple[str, object]:
    """A checked-out tree with one file per document, and the names of its repositories."""
    root = scratch_path(spark, "tree")
    files = view(spark, sf, "tree_files")

    def save(batches):
        opened, base = _open_root(root)
        for batch in batches:
            for repo, name, text in batch.itertuples(index=False):
                path = f"{base}/{repo.replace('/', '__')}/{name}"
                opened.create_dir(path.rsplit("/", 1)[0])
                with opened.open_output_stream(path, compression=None) as out:
                    out.write(text.encode())
            yield batch[["file_name"]].head(0)

    files.select("repo_name", "file_name", "text").mapInPandas(save, "file_name string").count()
    return root, files.select("repo_name").distinct()


def _read_tree(spark, sf):
    root, repos = land_tree(spark, sf)
    return read_source_tree(repos, root).select(
        "repo_name", "file_name", "length", F.md5("content").alias("content_md5")
    )


Q["read_source_tree"] = _read_tree
SQL["read_source_tree"] = sql(
    "SELECT repo_name, file_name, strlen(text) AS length, md5(text) AS content_md5 FROM tree_files", "tree_files"
)


def _decode(spark, sf):
    raw = F.encode("text", "UTF-8")
    content = (
        F.when(F.col("id") % 4 == 1, F.encode("text", "UTF-16"))
        .when((F.col("id") % 4 == 2) & (F.octet_length("text") > 3000), F.concat(raw, F.lit(b"\xff")))
        .when(F.col("id") % 4 == 3, F.concat(F.lit(b"\xef\xbb\xbf"), raw))
        .otherwise(raw)
    )
    return decode_text(view(spark, sf, "code_files").select("id", content.alias("content")))


Q["decode_text"] = _decode
SQL["decode_text"] = sql("SELECT id, text FROM code_files", "code_files")

RECORD_COLUMNS = ", ".join(CODE_RECORD.fieldNames())


def _records(spark, sf):
    return view(spark, sf, "code_files").select(*CODE_RECORD.fieldNames(), F.col("month_no").alias("month"))


def _read_records(spark, sf):
    folder = scratch_path(spark, "raw")
    files = view(spark, sf, "code_files")
    line = F.to_json(F.struct(*CODE_RECORD.fieldNames()), {"ignoreNullFields": "false"})
    broken = F.when(F.col("id") % 50 == 7, F.substring(line, 1, 30)).when(F.col("id") % 50 == 8, "").otherwise(line)
    files.select(broken.alias("value"), F.col("month_no").alias("month")).write.partitionBy("month").text(folder)
    read = R.read_code_records(spark, folder, pattern="*.txt")
    return read.select(*CODE_RECORD.fieldNames(), "month")


Q["read_code_records"] = _read_records
SQL["read_code_records"] = sql(
    f"SELECT {RECORD_COLUMNS}, month_no AS month FROM code_files WHERE id % 50 NOT IN (7, 8)", "code_files"
)


def _write_records(spark, sf):
    folder = scratch_path(spark, "records")
    rows = _records(spark, sf)
    R.write_code_records(rows, folder)
    R.write_code_records(rows.where("month = 3"), folder)  # a rerun replaces its month only
    return R.read_code_records(spark, folder).select(*CODE_RECORD.fieldNames(), "month")


Q["write_code_records"] = _write_records
SQL["write_code_records"] = sql(f"SELECT {RECORD_COLUMNS}, month_no AS month FROM code_files", "code_files")


def _batches(spark, sf):
    files = view(spark, sf, "code_files").select("id", "repo_name")
    return R.assign_output_batches(files, ["id", "repo_name"], next_batch=3)


Q["assign_output_batches"] = _batches
SQL["assign_output_batches"] = sql(
    """SELECT c.id, c.repo_name, b.batch FROM code_files c JOIN (
         SELECT repo_name, CAST((row_number() OVER (ORDER BY min(id), repo_name) - 1) // 10 + 3 AS BIGINT) AS batch
         FROM code_files GROUP BY repo_name) b USING (repo_name)""",
    "code_files",
)

Q["next_output_index"] = lambda spark, sf: R.next_output_index(view(spark, sf, "code_files"))
SQL["next_output_index"] = sql("SELECT CAST(max(batch) + 1 AS BIGINT) AS next_batch FROM code_files", "code_files")


def _language_csv(spark, sf):
    folder = scratch_path(spark, "report")
    R.write_language_csv(language_distribution(view(spark, sf, "code_files"), _dim(spark, sf)), folder)
    return spark.read.option("header", True).schema("Language string, Count long").csv(folder)


def _collect(spark, sf):
    root, repos = land_tree(spark, sf)
    meta = view(spark, sf, "repo_metadata").join(repos, "repo_name", "left_semi")
    return jobs.collect_records(meta, root, _dim(spark, sf), _extensions(spark, sf))


Q["write_language_csv"] = _language_csv
Q["collect_records_job"] = _collect

SQL["write_language_csv"] = DISCOVERY_SQL["language_distribution"]
SQL["collect_records_job"] = sql(
    f"""SELECT v.repo_name, m.description, m.stars, v.file_count, m.size AS size_kb, v.detected AS language,
               m.license, v.file_name, v.text, b.batch
        FROM (SELECT *, count(*) OVER (PARTITION BY repo_name) AS file_count, {DETECTED} AS detected
              FROM tree_files WHERE {VALID}) v
        JOIN repo_metadata m USING (repo_name)
        JOIN (SELECT repo_name, CAST((row_number() OVER (ORDER BY repo_name) - 1) // 10 AS BIGINT) AS batch
              FROM (SELECT DISTINCT repo_name FROM tree_files JOIN repo_metadata USING (repo_name) WHERE {VALID}) r) b
          USING (repo_name)""",
    "tree_files", "repo_metadata", "extension_dim",
)
