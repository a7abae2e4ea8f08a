"""Inputs of the checks: views over the given tables, shared by Spark and the oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from srcsieve.operators.joins import spread
from srcsieve.session import ship_package

TABLES = ("customer", "part", "events", "documents", "pages", "conversations")

CODE_FILES = """
SELECT doc_id AS id,
       'owner' || CAST(doc_id % 150 AS STRING) || '/repo' AS repo_name,
       CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'about ' || source END AS description,
       doc_id % 900 AS stars,
       doc_id % 7 + 1 AS file_count,
       doc_id % 150 * 1000 AS size_kb,
       CASE doc_id % 8 WHEN 0 THEN 'Python' WHEN 1 THEN 'XML' WHEN 2 THEN 'xml'
            WHEN 3 THEN 'HTML' WHEN 4 THEN 'JavaScript' WHEN 5 THEN 'R'
            WHEN 6 THEN 'Go' ELSE NULL END AS language,
       'mit' AS license,
       CASE doc_id % 12 WHEN 0 THEN 'src/a.py' WHEN 1 THEN 'lib/B.XML' WHEN 2 THEN '.gitignore'
            WHEN 3 THEN 'web/index.html' WHEN 4 THEN 'node_modules/x/y.js' WHEN 5 THEN 'R/m.R'
            WHEN 6 THEN 'cmd/main.go' WHEN 7 THEN 'README.md' WHEN 8 THEN 'Makefile'
            WHEN 9 THEN 'inc/v.tar.gz' WHEN 10 THEN 'inc/p.h' ELSE 'venv/lib/z.py' END AS file_name,
       CASE WHEN doc_id % 16 = 1 THEN '<?xml version="1.0"?>' || chr(10) || text
            WHEN doc_id % 16 = 11 THEN '<script>' || text || '</script>'
            WHEN doc_id % 40 = 19 THEN '<![ if x ]>' || text
            WHEN doc_id % 40 = 27 THEN '<![foo[ x ]]>' || text
            WHEN doc_id % 40 = 35 THEN text || chr(1)
            WHEN doc_id % 50 = 5 THEN repeat('0123456789 ' || chr(10), 20)
            ELSE text END AS text,
       CAST(doc_id % 12 + 1 AS INT) AS month_no,
       doc_id % 5 AS batch
FROM documents
"""

# One row per file of a source tree; names are unique within a repository.
TREE_FILES = """
SELECT repo_name, CAST(id AS STRING) || '/' || file_name AS file_name, text
FROM (SELECT id, repo_name, text, CASE WHEN id % 24 = 0 THEN 'src/__init__.py' ELSE file_name END AS file_name
      FROM code_files) f
"""

HTML_FILES = """
SELECT page_id AS id, CASE WHEN page_id % 3 = 0 THEN 'html' ELSE 'HTML' END AS language,
       CASE WHEN page_id % 5 = 1 THEN '<script>' || html || '</script>'
            WHEN page_id % 5 = 2 THEN '<!-- ' || replace(html, '-->', '') || ' --><p>short &amp; plain</p>'
            WHEN page_id % 25 = 3 THEN '<![ x' || html
            WHEN page_id % 25 = 4 THEN '<p>shown</p><style>' || html
            ELSE html END AS text
FROM pages
"""

ARCHIVE_EVENTS = """
SELECT event_id, CAST(ts AS STRING) AS created_at,
       CASE event_type WHEN 'view' THEN 'PushEvent' WHEN 'signup' THEN 'CreateEvent'
            ELSE 'WatchEvent' END AS type,
       'owner' || CAST(user_id AS STRING) || '/repo' AS repo_name
FROM events
"""

REPO_RESPONSES = """
SELECT 'owner' || CAST(c_custkey AS STRING) || '/repo' AS full_name,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END AS description,
       CASE WHEN c_custkey % 31 = 3 THEN NULL WHEN c_custkey % 31 = 5 THEN 50
            WHEN c_custkey % 31 = 6 THEN 49 ELSE c_custkey * 37 % 400 END AS stargazers_count,
       CASE c_custkey % 41 WHEN 1 THEN 50000 WHEN 2 THEN 49999 WHEN 3 THEN 1000000
            WHEN 4 THEN 1000001 ELSE c_custkey * 7919 % 1300000 END AS size,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'Python' WHEN 'BUILDING' THEN 'Go'
            WHEN 'AUTOMOBILE' THEN 'HTML' WHEN 'FURNITURE' THEN 'R' ELSE NULL END AS language,
       CASE c_custkey % 3 WHEN 0 THEN 'mit' WHEN 1 THEN '' ELSE NULL END AS license_key,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'dev' END AS default_branch
FROM customer
"""

REPO_METADATA = """
SELECT full_name AS repo_name, description, stargazers_count AS stars,
       coalesce(default_branch, 'main') AS default_branch,
       coalesce(nullif(license_key, ''), 'null') AS license, size, language
FROM repo_responses
"""

SEEN = """
SELECT CAST(c_custkey % 5 + 1 AS INT) AS month_no, 'owner' || CAST(c_custkey AS STRING) || '/repo' AS repo_name,
       CAST(1 AS BIGINT) AS n
FROM customer WHERE c_custkey % 3 = 0
"""

# A few real names, and one made-up language per part that fights over shared extensions.
LANGUAGE_TOKENS = """
SELECT CAST(pos AS BIGINT) AS pos, language, CAST(nth AS BIGINT) AS nth, token FROM (VALUES
  (0, 'Python', 0, '.py'), (0, 'Python', 1, '.pyw'), (1, 'C', 0, '.c'), (1, 'C', 1, '.h'),
  (2, 'C++', 0, '.cpp'), (2, 'C++', 1, '.h'), (2, 'C++', 2, '.hpp'), (3, 'R', 0, '.R'), (3, 'R', 1, '.r'),
  (4, 'HTML', 0, '.html'), (4, 'HTML', 1, '.htm'), (5, 'XML', 0, '.xml'),
  (6, 'JavaScript', 0, '.js'), (6, 'JavaScript', 1, 'Jakefile'), (7, 'Go', 0, '.go'),
  (8, 'Markdown', 0, '.md'), (10, 'CSV', 0, '.csv')) AS t(pos, language, nth, token)
UNION ALL SELECT 100 + p_partkey, 'Lang' || CAST(p_partkey AS STRING), 0, '.' || split_part(p_name, ' ', 2) FROM part
UNION ALL SELECT 100 + p_partkey, 'Lang' || CAST(p_partkey AS STRING), 1, upper('.' || split_part(p_name, ' ', 1)) FROM part
UNION ALL SELECT 100 + p_partkey, 'Lang' || CAST(p_partkey AS STRING), 2, split_part(p_name, ' ', 1) FROM part
"""

EXTENSION_DIM = """
SELECT extension, language FROM (
  SELECT lower(token) AS extension, language,
         row_number() OVER (PARTITION BY lower(token) ORDER BY pos DESC, nth DESC) AS rn
  FROM language_tokens WHERE token LIKE '.%') t WHERE rn = 1
"""

# Every document and a changed copy, for near-duplicate detection.
NEAR_DOCS = """
SELECT doc_id AS id, text FROM documents
UNION ALL
SELECT doc_id + 1000000000, CASE doc_id % 4 WHEN 0 THEN text || ' and a tail of words'
       WHEN 1 THEN replace(text, 'ment', 'mant') WHEN 2 THEN 'A head. ' || text
       ELSE replace(text, 'e', 'a') END
FROM documents
"""

# Whole texts as code of seven languages: some of their words open or close comments and strings.
COMMENTED_FILES = """
SELECT doc_id AS id, CASE doc_id % 8 WHEN 0 THEN 'Python' WHEN 1 THEN 'JavaScript' WHEN 2 THEN 'R' WHEN 3 THEN 'XML'
            WHEN 4 THEN 'SQL' WHEN 5 THEN 'C' WHEN 6 THEN 'Go' ELSE 'Unheard of' END AS language,
       replace(replace(replace(replace(replace(replace(replace(replace(replace(text,
         ' the ', ' # -- // the '), ' of ', ' of' || chr(10)), ' and ', ' /* and <!-- '), ' to ', ' to */ --> '),
         ' a ', ' "a '), ' in ', ' in" '), ' is ', ' `is' || chr(39) || ' '), ' for ', ' ' || chr(92) || '" for '),
         ' that ', ' ' || repeat('"', 3) || 'that ') AS text
FROM documents
"""

VIEWS = {
    "commented_files": COMMENTED_FILES,
    "code_files": CODE_FILES,
    "tree_files": TREE_FILES,
    "html_files": HTML_FILES,
    "archive_events": ARCHIVE_EVENTS,
    "repo_responses": REPO_RESPONSES,
    "repo_metadata": REPO_METADATA,
    "seen": SEEN,
    "language_tokens": LANGUAGE_TOKENS,
    "extension_dim": EXTENSION_DIM,
    "near_docs": NEAR_DOCS,
}
NEEDS = {"tree_files": ["code_files"], "repo_metadata": ["repo_responses"], "extension_dim": ["language_tokens"]}


def sql(query: str, *views: str, ctes: str = "", recursive: bool = False) -> str:
    """``query`` with the named views, and what they need, in front of it."""
    names: list[str] = []
    for view in views:
        for name in [*NEEDS.get(view, []), view]:
            if name not in names:
                names.append(name)
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in names]
    if ctes:
        parts.append(ctes.strip())
    word = "WITH RECURSIVE " if recursive else "WITH "
    return (word + ",\n".join(parts) + "\n" if parts else "") + query.strip()


#: Text tables come as files of one row group, which one task would read.
TEXT_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows, TEXT_KEYS[name]) if name in TEXT_KEYS else rows


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared view over the tables of ``sf_dir``."""
    ship_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    text = sql(f"SELECT * FROM {name}", name)
    for base in TABLES:
        if re.search(rf"FROM {base}\b", text):
            table(spark, sf_dir, base).createOrReplaceTempView(base)
    return spark.sql(text)


def language_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary: languages with their list of tokens, one without any list."""
    tokens = view(spark, sf_dir, "language_tokens")
    listed = tokens.groupBy("pos", "language").agg(F.array_sort(F.collect_list(F.struct("nth", "token"))).alias("t"))
    empty = spark.sql("SELECT 9L AS pos, 'Empty' AS language, CAST(NULL AS ARRAY<STRING>) AS extensions")
    return listed.select("pos", "language", F.col("t.token").alias("extensions")).unionByName(empty)
