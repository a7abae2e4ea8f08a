"""Discovery, languages, files, state: queries with their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import language_map, sql, table, view
from srcsieve.constants import EXCLUDED_EXTENSIONS, EXCLUDED_LANGUAGES, EXTRA_MIME_TYPES, IGNORED_DIRS, MONTHS
from srcsieve.functions.text import file_suffix, token_count
from srcsieve.operators import discovery as D
from srcsieve.operators import files as FI
from srcsieve.operators import languages as L
from srcsieve.operators import seen as S
from srcsieve.operators import sketches
from srcsieve.operators.reports import dataset_summary
from srcsieve.plans import jobs
from srcsieve.session import scratch_path
from srcsieve.sources.archive import archive_paths

Q: dict = {}
SQL: dict[str, str] = {}


def names(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# -- events ---------------------------------------------------------------------------------

def _archive_paths(spark, sf):
    view(spark, sf, "archive_events")
    bounds = table(spark, sf, "events").agg(
        F.date_trunc("hour", F.min("ts")).alias("start"), F.date_trunc("hour", F.max("ts")).alias("end")
    )
    return archive_paths(bounds, "start", "end", "landed/")


Q["archive_paths"] = _archive_paths
SQL["archive_paths"] = """
SELECT 'landed/' || strftime(h, '%Y-%m-%d-%-H') || '.json.gz' AS path
FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS h
      FROM events) t
"""

Q["filter_event_types"] = lambda spark, sf: D.filter_event_types(view(spark, sf, "archive_events"))
SQL["filter_event_types"] = sql(
    "SELECT * FROM archive_events WHERE type IN ('PushEvent', 'CreateEvent')", "archive_events"
)

Q["latest_event_per_repo"] = lambda spark, sf: D.latest_event_per_repo(
    D.filter_event_types(view(spark, sf, "archive_events"))
)
SQL["latest_event_per_repo"] = sql(
    """SELECT repo_name, max(created_at) AS created_at FROM archive_events
       WHERE type IN ('PushEvent', 'CreateEvent') GROUP BY repo_name""",
    "archive_events",
)

POSITION = ["created_at", "event_id"]
FIRST_SEEN = """SELECT repo_name, created_at, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY repo_name ORDER BY created_at, event_id) AS rn
    FROM archive_events WHERE type IN ('PushEvent', 'CreateEvent')) t WHERE rn = 1"""

Q["first_seen_order"] = lambda spark, sf: D.first_seen_order(
    D.filter_event_types(view(spark, sf, "archive_events")), POSITION
)
SQL["first_seen_order"] = sql(FIRST_SEEN, "archive_events")

Q["first_n_repos"] = lambda spark, sf: D.first_n_repos(
    D.filter_event_types(view(spark, sf, "archive_events")), POSITION, 100
)
SQL["first_n_repos"] = sql(
    f"SELECT * FROM ({FIRST_SEEN}) f ORDER BY created_at, event_id, repo_name LIMIT 100", "archive_events"
)

# -- repository rules -----------------------------------------------------------------------

def _raw_meta(spark, sf):
    return view(spark, sf, "repo_responses").select(
        "*", F.struct(F.col("license_key").alias("key")).alias("license")
    )


def _languages(spark, sf):
    return L.exclude_languages(language_map(spark, sf))


KNOWN = f"""known AS (SELECT DISTINCT language FROM language_tokens WHERE language NOT IN ({names(EXCLUDED_LANGUAGES)})
    UNION ALL SELECT 'Empty')"""

Q["project_repo_metadata"] = lambda spark, sf: D.project_repo_metadata(_raw_meta(spark, sf))
SQL["project_repo_metadata"] = sql("SELECT * FROM repo_metadata", "repo_metadata")

for name, function, where in (
    ("filter_min_stars", D.filter_min_stars, "stars >= 50"),
    ("filter_repo_size", D.filter_repo_size, "size >= 50000 AND size <= 1000000"),
    ("filter_has_language", D.filter_has_language, "language IS NOT NULL"),
):
    Q[name] = lambda spark, sf, function=function: function(view(spark, sf, "repo_metadata"))
    SQL[name] = sql(f"SELECT * FROM repo_metadata WHERE {where}", "repo_metadata")

Q["filter_supported_language"] = lambda spark, sf: D.filter_supported_language(
    view(spark, sf, "repo_metadata"), _languages(spark, sf)
)
SQL["filter_supported_language"] = sql(
    "SELECT * FROM repo_metadata WHERE language IN (SELECT language FROM known)",
    "repo_metadata", "language_tokens", ctes=KNOWN,
)

REASON = """CASE WHEN stars IS NULL OR stars < 50 THEN 'insufficient stars'
    WHEN size IS NULL OR size < 50000 OR size > 1000000 THEN 'invalid size'
    WHEN language IS NULL THEN 'no language'
    WHEN language NOT IN (SELECT language FROM known) THEN 'unsupported language' END"""

Q["repo_reject_reason"] = lambda spark, sf: D.repo_reject_reason(
    view(spark, sf, "repo_metadata"), _languages(spark, sf)
)
SQL["repo_reject_reason"] = sql(
    f"SELECT *, {REASON} AS reason FROM repo_metadata", "repo_metadata", "language_tokens", ctes=KNOWN
)
Q["repo_reject_counts"] = lambda spark, sf: D.reject_counts(
    D.repo_reject_reason(view(spark, sf, "repo_metadata"), _languages(spark, sf))
)
SQL["repo_reject_counts"] = sql(
    f"SELECT {REASON} AS reason, count(*) AS repos FROM repo_metadata GROUP BY 1",
    "repo_metadata", "language_tokens", ctes=KNOWN,
)
Q["select_repos"] = lambda spark, sf: D.select_repos(view(spark, sf, "repo_metadata"), _languages(spark, sf))
SQL["select_repos"] = sql(
    f"SELECT * FROM repo_metadata WHERE {REASON} IS NULL", "repo_metadata", "language_tokens", ctes=KNOWN
)

# -- languages ------------------------------------------------------------------------------

Q["extension_language_dim"] = lambda spark, sf: L.extension_language_dim(language_map(spark, sf))
SQL["extension_language_dim"] = sql("SELECT * FROM extension_dim", "extension_dim")

Q["exclude_languages"] = lambda spark, sf: _languages(spark, sf).select("pos", "language")
SQL["exclude_languages"] = sql(
    f"""SELECT DISTINCT pos, language FROM language_tokens WHERE language NOT IN ({names(EXCLUDED_LANGUAGES)})
        UNION ALL SELECT 9, 'Empty'""",
    "language_tokens",
)
Q["supported_extensions"] = lambda spark, sf: L.supported_extensions(_languages(spark, sf))
TOKENS = f"SELECT DISTINCT token AS extension FROM language_tokens WHERE language NOT IN ({names(EXCLUDED_LANGUAGES)})"
SQL["supported_extensions"] = sql(TOKENS, "language_tokens")

SUFFIX = r"lower(regexp_extract(file_name, '[^/](\.[^./]+)\z', 1))"
Q["file_suffix"] = lambda spark, sf: view(spark, sf, "code_files").select(
    "id", "file_name", file_suffix("file_name").alias("suffix")
)
SQL["file_suffix"] = sql(
    """SELECT id, file_name,
              CASE WHEN base NOT LIKE '_%.%' OR base LIKE '%.' THEN ''
                   ELSE lower('.' || list_last(string_split(base, '.'))) END AS suffix
       FROM (SELECT id, file_name, list_last(string_split(file_name, '/')) AS base FROM code_files) t""",
    "code_files",
)

DETECTED = f"coalesce((SELECT d.language FROM extension_dim d WHERE d.extension = {SUFFIX}), 'Unknown')"


def _dim(spark, sf):
    return L.extension_language_dim(language_map(spark, sf))


Q["detect_language"] = lambda spark, sf: L.detect_language(
    view(spark, sf, "code_files").select("id", "file_name"), _dim(spark, sf)
)
SQL["detect_language"] = sql(
    f"SELECT id, file_name, {DETECTED} AS language FROM code_files", "code_files", "extension_dim"
)
Q["relabel_language"] = lambda spark, sf: L.relabel_language(view(spark, sf, "code_files"), _dim(spark, sf))
SQL["relabel_language"] = sql(
    f"SELECT * REPLACE ({DETECTED} AS language) FROM code_files", "code_files", "extension_dim"
)
Q["language_distribution"] = lambda spark, sf: L.language_distribution(view(spark, sf, "code_files"), _dim(spark, sf))
SQL["language_distribution"] = sql(
    f"SELECT {DETECTED} AS \"Language\", count(*) AS \"Count\" FROM code_files GROUP BY 1",
    "code_files", "extension_dim",
)


def _language_mime(spark, sf):
    lexers = language_map(spark, sf).select(
        "pos", F.col("language").alias("name"),
        F.when(F.col("language") != "R", F.transform("extensions", lambda e: F.concat(F.lit("text/x-"), e))).alias("mime_types"),
    )
    files = view(spark, sf, "code_files").select("id", "language")
    return L.language_mime(files, L.mime_dim(spark, lexers))


Q["language_mime"] = _language_mime
EXTRA_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in EXTRA_MIME_TYPES.items())
SQL["language_mime"] = sql(
    """SELECT id, language, (SELECT max(mime) FROM (
           SELECT lower(language) AS l, 'text/x-' || token AS mime FROM language_tokens WHERE nth = 0 AND language <> 'R'
           UNION ALL SELECT * FROM extras) m WHERE m.l = lower(c.language)) AS mime
       FROM code_files c""",
    "code_files", "language_tokens", ctes=f"extras(l, mime) AS (VALUES {EXTRA_ROWS})",
)

# -- files ----------------------------------------------------------------------------------

NOT_IGNORED = f"NOT list_has_any(string_split(file_name, '/'), [{names(IGNORED_DIRS)}])"
SUPPORTED = f"{SUFFIX} IN ({TOKENS})"
NOT_EXCLUDED = f"{SUFFIX} NOT IN ({names(EXCLUDED_EXTENSIONS)})"
VALID = f"{NOT_IGNORED} AND {SUPPORTED} AND {NOT_EXCLUDED}"


def _extensions(spark, sf):
    return L.supported_extensions(_languages(spark, sf))


Q["filter_ignored_dirs"] = lambda spark, sf: FI.filter_ignored_dirs(view(spark, sf, "code_files").drop("text"))
SQL["filter_ignored_dirs"] = sql(f"SELECT * EXCLUDE (text) FROM code_files WHERE {NOT_IGNORED}", "code_files")
Q["filter_supported_extension"] = lambda spark, sf: FI.filter_supported_extension(
    view(spark, sf, "code_files").drop("text"), _extensions(spark, sf)
)
SQL["filter_supported_extension"] = sql(
    f"SELECT * EXCLUDE (text) FROM code_files WHERE {SUPPORTED}", "code_files", "language_tokens"
)
Q["filter_excluded_extension"] = lambda spark, sf: FI.filter_excluded_extension(
    view(spark, sf, "code_files").drop("text")
)
SQL["filter_excluded_extension"] = sql(f"SELECT * EXCLUDE (text) FROM code_files WHERE {NOT_EXCLUDED}", "code_files")
Q["valid_code_files"] = lambda spark, sf: FI.valid_code_files(
    view(spark, sf, "code_files").drop("text"), _extensions(spark, sf)
)
SQL["valid_code_files"] = sql(
    f"SELECT * EXCLUDE (text) FROM code_files WHERE {VALID}", "code_files", "language_tokens"
)


def _repo_file_count(spark, sf):
    files = view(spark, sf, "code_files").drop("file_count", "text")
    return FI.repo_file_count(FI.valid_code_files(files, _extensions(spark, sf)))


Q["repo_file_count"] = _repo_file_count
SQL["repo_file_count"] = sql(
    f"""SELECT * EXCLUDE (text, file_count), count(*) OVER (PARTITION BY repo_name) AS file_count
        FROM code_files WHERE {VALID}""",
    "code_files", "language_tokens",
)


def _assemble(spark, sf):
    files = FI.valid_code_files(view(spark, sf, "code_files"), _extensions(spark, sf))
    readable = files.withColumn("text", F.when(F.col("id") % 9 != 4, F.col("text")))
    return FI.assemble_code_records(
        readable, FI.file_counts(files), view(spark, sf, "repo_metadata"), _dim(spark, sf)
    )


Q["assemble_code_records"] = _assemble
SQL["assemble_code_records"] = sql(
    f"""SELECT v.repo_name, m.description, m.stars, v.file_count, m.size AS size_kb,
               v.detected AS language, m.license, v.file_name, v.text
        FROM (SELECT id, repo_name, file_name, text, count(*) OVER (PARTITION BY repo_name) AS file_count,
                     {DETECTED} AS detected FROM code_files WHERE {VALID}) v
        JOIN repo_metadata m USING (repo_name) WHERE v.id % 9 <> 4""",
    "code_files", "repo_metadata", "extension_dim",
)

# -- state ----------------------------------------------------------------------------------

def _repos(spark, sf):
    return view(spark, sf, "repo_metadata").select("repo_name")


Q["skip_seen_repos"] = lambda spark, sf: S.skip_seen_repos(_repos(spark, sf), view(spark, sf, "seen"), 2)
SQL["skip_seen_repos"] = sql(
    "SELECT repo_name FROM repo_metadata WHERE repo_name NOT IN (SELECT repo_name FROM seen WHERE month_no = 2)",
    "repo_metadata", "seen",
)
Q["skip_repos_seen_in_other_months"] = lambda spark, sf: S.skip_repos_seen_in_other_months(
    _repos(spark, sf), view(spark, sf, "seen"), 2
)
SQL["skip_repos_seen_in_other_months"] = sql(
    "SELECT repo_name FROM repo_metadata WHERE repo_name NOT IN (SELECT repo_name FROM seen WHERE month_no <> 2)",
    "repo_metadata", "seen",
)


def _mark_seen(spark, sf):
    judged = D.repo_reject_reason(view(spark, sf, "repo_metadata"), _languages(spark, sf))
    return S.mark_seen(view(spark, sf, "seen"), jobs.attempts(judged, 2), transient=("invalid size",))


Q["mark_seen"] = _mark_seen
SQL["mark_seen"] = sql(
    f"""SELECT month_no, repo_name, CAST(sum(n) AS BIGINT) AS n FROM (
          SELECT * FROM seen UNION ALL
          SELECT 2, repo_name, 1 FROM repo_metadata WHERE coalesce({REASON}, '') <> 'invalid size') t
        GROUP BY 1, 2""",
    "repo_metadata", "seen", "language_tokens", ctes=KNOWN,
)


def _blank_some(spark, sf):
    empty = F.when(F.col("id") % 10 == 0, "").when(F.col("id") % 10 == 1, F.lit(None))
    return view(spark, sf, "code_files").withColumn("repo_name", F.when(F.col("id") % 10 > 1, F.col("repo_name")).otherwise(empty))


Q["repos_in_batch"] = lambda spark, sf: S.repos_in_batch(_blank_some(spark, sf))
SQL["repos_in_batch"] = sql("SELECT DISTINCT repo_name FROM code_files WHERE id % 10 > 1", "code_files")

Q["first_month_per_repo"] = lambda spark, sf: S.first_month_per_repo(
    view(spark, sf, "code_files").select("id", "repo_name", "month_no")
)
SQL["first_month_per_repo"] = sql(
    """SELECT id, repo_name, month_no FROM code_files c
       WHERE month_no = (SELECT min(month_no) FROM code_files d WHERE d.repo_name = c.repo_name)""",
    "code_files",
)


def _finished(spark, sf):
    files = view(spark, sf, "code_files")
    todo = files.select("month_no", "batch").distinct()
    stage = F.when(F.col("month_no") % 3 == 0, "filtered").otherwise("deduped")
    manifest = todo.where("(month_no + batch) % 2 = 0").withColumn("stage", stage)
    return S.skip_finished_batches(todo, manifest)


Q["skip_finished_batches"] = _finished
SQL["skip_finished_batches"] = sql(
    """SELECT DISTINCT month_no, batch, CASE WHEN (month_no + batch) % 2 = 0 THEN 'filter' ELSE 'dedup' END AS start_at
       FROM code_files WHERE NOT ((month_no + batch) % 2 = 0 AND month_no % 3 = 0)""",
    "code_files",
)


def _resume(spark, sf):
    files = view(spark, sf, "code_files").drop("text")
    return S.resume_partial_batch(files.where("repo_name < 'owner3' AND id % 2 = 0"), files)


Q["resume_partial_batch"] = _resume
SQL["resume_partial_batch"] = sql(
    """SELECT * EXCLUDE (text) FROM code_files c WHERE (repo_name < 'owner3' AND id % 2 = 0)
       OR repo_name NOT IN (SELECT repo_name FROM code_files WHERE repo_name < 'owner3' AND id % 2 = 0)""",
    "code_files",
)

# -- reports and jobs -----------------------------------------------------------------------

Q["dataset_summary"] = lambda spark, sf: dataset_summary(view(spark, sf, "code_files"))
SQL["dataset_summary"] = sql(
    r"""SELECT count(DISTINCT repo_name) AS repos, count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
               CAST(sum(len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\s]'))) AS BIGINT) AS tokens
        FROM code_files""",
    "code_files",
)


def _monthly_sketches(spark, sf):
    """Months summarised in two runs, merged from what was written."""
    path, files = scratch_path(spark, "sketches"), view(spark, sf, "code_files")
    for run in (0, 1):
        sketches.save_sketches(files.where(F.col("month_no") % 2 == run), path, "month_no")
    return sketches.summary_from_sketches(spark, path, quantiles=RANKS)


RANKS = (0.1, 0.25, 0.5, 0.75, 0.9)


def _summary_from_sketches(spark, sf):
    """Sums and, for so few distinct values, frequent languages are exact; repositories are within their error."""
    exact = view(spark, sf, "code_files").agg(F.count_distinct("repo_name")).scalar()
    report = _monthly_sketches(spark, sf).withColumn("top", F.explode("top_languages"))
    return report.select(
        "files", "bytes", "tokens", F.coalesce("top.item", F.lit("none")).alias("language"), F.col("top.count").alias("n"),
        (F.abs(F.col("repos") - exact) <= 0.025 * exact).alias("repos_within"),
    )


Q["summary_from_sketches"] = _summary_from_sketches
SQL["summary_from_sketches"] = sql(
    r"""SELECT t.files, t.bytes, t.tokens, coalesce(language, 'none') AS language, count(*) AS n, TRUE AS repos_within
        FROM code_files, (SELECT count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
               CAST(sum(len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\s]'))) AS BIGINT) AS tokens
             FROM code_files) t
        GROUP BY ALL""",
    "code_files",
)


def _quantile_ranks(spark, sf):
    """How far the true rank of each estimated quantile is from the rank asked for."""
    values = _monthly_sketches(spark, sf).select("token_quantiles").scalar()
    shares = view(spark, sf, "code_files").withColumn("tokens", token_count("text")).agg(*(
        F.struct(
            F.lit(rank).alias("rank"),
            F.avg((F.col("tokens") <= values[nth]).cast("double")).alias("at_most"),
            F.avg((F.col("tokens") < values[nth]).cast("double")).alias("below"),
        ).alias(f"q{nth}")
        for nth, rank in enumerate(RANKS)
    ))
    within = (F.col("below") <= F.col("rank") + 0.02) & (F.col("at_most") >= F.col("rank") - 0.02)
    return shares.select(F.inline(F.array(*(f"q{nth}" for nth in range(len(RANKS)))))).select("rank", within.alias("within"))


Q["token_quantiles_from_sketches"] = _quantile_ranks
SQL["token_quantiles_from_sketches"] = sql(
    f"SELECT CAST(rank AS DOUBLE) AS rank, count(*) > 0 AS within FROM code_files, unnest({list(RANKS)}) AS r(rank) GROUP BY 1", "code_files"
)


def _discover(spark, sf):
    return jobs.discover_repos(
        view(spark, sf, "archive_events"), _raw_meta(spark, sf), view(spark, sf, "seen"), _languages(spark, sf), 2
    ).select("repo_name", "stars", "language", "reason")


Q["discover_repos_job"] = _discover
SQL["discover_repos_job"] = sql(
    f"""SELECT r.repo_name, m.stars, m.language,
               CASE WHEN m.repo_name IS NULL THEN 'no metadata' ELSE {REASON.replace('language NOT IN', 'm.language NOT IN')
                    .replace('language IS NULL', 'm.language IS NULL')} END AS reason
        FROM (SELECT DISTINCT repo_name FROM archive_events WHERE type IN ('PushEvent', 'CreateEvent')) r
        LEFT JOIN repo_metadata m USING (repo_name)
        WHERE r.repo_name NOT IN (SELECT repo_name FROM seen)""",
    "archive_events", "repo_metadata", "seen", "language_tokens", ctes=KNOWN,
)
