"""Deduplication: the oracle computes the same MinHash bands in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import quality as G
from checks.views import sql, view
from srcsieve.constants import CHAR_NGRAMS, HASHES_PER_BAND, MINHASH_SEED, NUM_BANDS
from srcsieve.operators import components as C
from srcsieve.operators import exact_dedup as E
from srcsieve.operators import fuzzy_dedup as Z
from srcsieve.operators import minhash as M
from srcsieve.operators import near_index as N
from srcsieve.operators import set_join as J
from srcsieve.operators.joins import drop_ids
from srcsieve.plans import jobs
from srcsieve.session import scratch_path

Q: dict = {}
SQL: dict[str, str] = {}

ID = """'doc_prefix-' || sha256(coalesce(repo_name, '') || chr(10) || coalesce(file_name, '') || chr(10) || md5(text))"""


def _files(spark, sf):
    return view(spark, sf, "code_files").withColumn("month", F.col("month_no"))


def _near(spark, sf):
    return view(spark, sf, "near_docs")


Q["add_doc_id"] = lambda spark, sf: E.add_doc_id(_files(spark, sf)).select("id", "my_id")
SQL["add_doc_id"] = sql(f"SELECT id, {ID} AS my_id FROM code_files", "code_files")

Q["exact_duplicate_groups"] = lambda spark, sf: E.exact_duplicate_groups(_files(spark, sf), "id")
SQL["exact_duplicate_groups"] = sql(
    """SELECT md5(text) AS text_md5, min(id) AS keep_id, count(*) AS copies FROM code_files
       GROUP BY 1 HAVING count(*) > 1""",
    "code_files",
)
Q["exact_dedup"] = lambda spark, sf: E.exact_dedup(_files(spark, sf).drop("month"), "id")
SQL["exact_dedup"] = sql(
    "SELECT * FROM code_files WHERE id IN (SELECT min(id) FROM code_files GROUP BY text)", "code_files"
)
Q["exact_dedup_by_month"] = lambda spark, sf: E.exact_dedup(
    _files(spark, sf).drop("month"), "id", scope=("month_no",)
)
SQL["exact_dedup_by_month"] = sql(
    "SELECT * FROM code_files WHERE id IN (SELECT min(id) FROM code_files GROUP BY month_no, text)", "code_files"
)

Q["char_shingles"] = lambda spark, sf: M.char_shingles(_files(spark, sf), "id").groupBy("id").agg(
    F.count(F.lit(1)).alias("shingles"), F.max("shingle").alias("last_shingle")
)

def shingle_ctes(docs: str) -> str:
    """``shingles(id, s)``, the distinct shingles of ``docs(id, text)``."""
    joined = " || ".join(f"lead(ch, {k}, '') OVER w" for k in range(CHAR_NGRAMS))
    return f"""
chars AS (SELECT id, unnest(cs) AS ch, generate_subscripts(cs, 1) AS pos, len(cs) AS n
          FROM (SELECT id, CASE WHEN text = '' THEN [''] ELSE string_split(text, '') END AS cs FROM {docs}) d),
grams AS (SELECT id, pos, n, {joined} AS s FROM chars WINDOW w AS (PARTITION BY id ORDER BY pos)),
shingles AS (SELECT DISTINCT id, s FROM grams WHERE pos <= greatest(n - {CHAR_NGRAMS - 1}, 1))"""


SQL["char_shingles"] = sql(
    "SELECT id, count(*) AS shingles, max(s) AS last_shingle FROM shingles GROUP BY id",
    "code_files", ctes=shingle_ctes("code_files"),
)


def minhash_ctes(docs: str) -> str:
    """``signed(id, signature)`` and ``buckets(id, band, bucket)`` of ``docs(id, text)``."""
    weights, multipliers, offsets = M.hash_parameters(CHAR_NGRAMS, NUM_BANDS * HASHES_PER_BAND, MINHASH_SEED)
    total = " + ".join(f"lead(cp, {k}, 0) OVER w * {weight}" for k, weight in enumerate(weights.tolist()))
    mask = "4294967295::UBIGINT"
    minima = ", ".join(
        f"min((((h * {a}::UBIGINT) & {mask}) + {b}::UBIGINT) & {mask})"
        for a, b in zip(multipliers.tolist(), offsets.tolist())
    )
    bands = ", ".join(
        f"md5(array_to_string(signature[{b * HASHES_PER_BAND + 1}:{(b + 1) * HASHES_PER_BAND}], ','))"
        for b in range(NUM_BANDS)
    )
    return f"""
codes AS (SELECT id, unnest(cps)::BIGINT AS cp, generate_subscripts(cps, 1) AS pos, len(cps) AS n
          FROM (SELECT id, CASE WHEN text = '' THEN [0] ELSE
                list_transform(string_split(text, ''), lambda c: unicode(c)) END AS cps FROM {docs}) d),
sums AS (SELECT id, pos, n, {total} AS total FROM codes WINDOW w AS (PARTITION BY id ORDER BY pos)),
h0 AS (SELECT id, (total % 4294967291)::UBIGINT AS h FROM sums WHERE pos <= greatest(n - {CHAR_NGRAMS - 1}, 1)),
h1 AS (SELECT id, (xor(h, h >> 16) * 2246822507::UBIGINT) & {mask} AS h FROM h0),
h2 AS (SELECT id, (xor(h, h >> 13) * 3266489909::UBIGINT) & {mask} AS h FROM h1),
h3 AS (SELECT id, xor(h, h >> 16) AS h FROM h2),
signed AS (SELECT id, [{minima}] AS signature FROM h3 GROUP BY id),
buckets AS (SELECT id, unnest(range(0, {NUM_BANDS}))::INT AS band, unnest([{bands}]) AS bucket FROM signed)"""


EDGES = """
edges AS (SELECT DISTINCT b.id, h.head FROM buckets b
          JOIN (SELECT band, bucket, min(id) AS head FROM buckets GROUP BY band, bucket) h USING (band, bucket)
          WHERE b.id <> h.head)"""
COMPONENTS = """
links AS (SELECT id AS a, head AS b FROM edges UNION SELECT head, id FROM edges),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a HAVING min(b) < a)"""

NEAR = minhash_ctes("near_docs")
Q["minhash_signatures"] = lambda spark, sf: M.minhash_signatures(_near(spark, sf), "id").select(
    "id", F.array_join(F.col("signature").cast("array<string>"), ",").alias("signature")
)
SQL["minhash_signatures"] = sql(
    "SELECT id, array_to_string(signature, ',') AS signature FROM signed", "near_docs", ctes=NEAR
)


def _buckets(spark, sf):
    return M.lsh_band_buckets(M.minhash_signatures(_near(spark, sf), "id"), "id").withColumn(
        "bucket", F.lower(F.hex("bucket"))
    )


Q["lsh_band_buckets"] = _buckets
SQL["lsh_band_buckets"] = sql("SELECT * FROM buckets", "near_docs", ctes=NEAR)

Q["lsh_candidate_edges"] = lambda spark, sf: M.lsh_candidate_edges(M.document_buckets(_near(spark, sf), "id"), "id")
SQL["lsh_candidate_edges"] = sql("SELECT id, head FROM edges", "near_docs", ctes=NEAR + "," + EDGES)


def _components(spark, sf):
    edges = M.lsh_candidate_edges(M.document_buckets(_near(spark, sf), "id"), "id")
    return C.duplicate_components(edges)


Q["duplicate_components"] = _components
SQL["duplicate_components"] = sql(
    "SELECT id, root FROM roots", "near_docs", ctes=",".join((NEAR, EDGES, COMPONENTS)), recursive=True
)

Q["fuzzy_dedup"] = lambda spark, sf: Z.fuzzy_dedup(_near(spark, sf), "id")
SQL["fuzzy_dedup"] = sql(
    "SELECT * FROM near_docs WHERE id NOT IN (SELECT id FROM roots)",
    "near_docs", ctes=",".join((NEAR, EDGES, COMPONENTS)), recursive=True,
)


def _pairs(spark, sf):
    docs = _near(spark, sf)
    edges = M.lsh_candidate_edges(M.document_buckets(docs, "id"), "id")
    return Z.near_duplicate_pairs(edges, docs).withColumn("jaccard", F.round("jaccard", 6))


Q["near_duplicate_pairs"] = _pairs
PAIRS = """
tied AS (SELECT * FROM near_docs WHERE id IN (SELECT id FROM edges UNION SELECT head FROM edges))"""
SHARED = """
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
shared AS (SELECT e.id, e.head, count(*) AS n FROM edges e JOIN shingles x ON x.id = e.id
           JOIN shingles y ON y.id = e.head AND y.s = x.s GROUP BY 1, 2)"""
SQL["near_duplicate_pairs"] = sql(
    """SELECT c.id, c.head, round(c.n::DOUBLE / (x.n + y.n - c.n), 6) AS jaccard
       FROM shared c JOIN sizes x ON x.id = c.id JOIN sizes y ON y.id = c.head
       WHERE c.n::DOUBLE / (x.n + y.n - c.n) >= 0.8""",
    "near_docs", ctes=",".join((NEAR, EDGES, PAIRS, shingle_ctes("tied"), SHARED)),
)


# The oracle compares every two documents that share a shingle.
LINKS = """
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
met AS (SELECT x.id AS a, y.id AS b, count(*) AS n FROM shingles x JOIN shingles y ON y.s = x.s AND y.id < x.id
             GROUP BY 1, 2),
exact_links AS (SELECT a, b FROM met o JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b
                WHERE o.n::DOUBLE / (x.n + y.n - o.n) >= 0.8),
both_ways AS (SELECT a, b FROM exact_links UNION SELECT b, a FROM exact_links),
exact_reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM exact_reach r JOIN both_ways l ON r.b = l.a),
linked AS (SELECT a AS id, least(a, min(b)) AS root FROM exact_reach GROUP BY a)"""
Q["similarity_groups"] = lambda spark, sf: J.similarity_groups(_near(spark, sf)).select("id", "root")
SQL["similarity_groups"] = sql(
    "SELECT id, root FROM linked", "near_docs", ctes=",".join((shingle_ctes("near_docs"), LINKS)), recursive=True
)


def _band_recall(spark, sf):
    docs = _near(spark, sf)
    return J.band_recall(docs, J.similarity_groups(docs), Z.fuzzy_duplicates(docs, "id"))


Q["band_recall"] = _band_recall
SQL["band_recall"] = sql(
    """SELECT count(e.id) AS linked, count(*) FILTER (e.id IS NOT NULL AND r.id IS NOT NULL) AS found,
              count(*) FILTER (e.id IS NULL AND r.id IS NOT NULL) AS extra
       FROM near_docs d LEFT JOIN (SELECT id FROM linked WHERE id <> root) e ON e.id = d.id LEFT JOIN roots r ON r.id = d.id""",
    "near_docs", ctes=",".join((NEAR, EDGES, COMPONENTS, shingle_ctes("near_docs"), LINKS)), recursive=True,
)


def _deduplicate(scope: str):
    def run(spark, sf):
        return Z.deduplicate(_files(spark, sf), scope).select("my_id", "repo_name", "file_name", "month_no", "text")

    return run


def _dedup_ctes(scope: list[str]) -> str:
    """``kept``, one row per text, and the ``roots`` of near copies, within ``scope`` groups."""
    parts = [f"CAST({c} AS VARCHAR)" for c in scope]
    identity = ID.replace("sha256(", "sha256(" + "".join(f"{p} || chr(10) || " for p in parts))
    groups = ", ".join([*scope, "text"])
    first = f"""
identified AS (SELECT *, {identity} AS my_id FROM (SELECT *, month_no AS month FROM code_files) c),
kept AS (SELECT * EXCLUDE (rn, id), my_id AS id
         FROM (SELECT *, row_number() OVER (PARTITION BY {groups} ORDER BY my_id) AS rn FROM identified) r WHERE rn = 1)"""
    signed = minhash_ctes("kept")
    if scope:
        key = "".join(f"{p} || ',' || " for p in parts)
        signed = signed.replace("md5(array_to_string(", f"md5({key}array_to_string(").replace(
            "FROM signed)", "FROM signed JOIN (SELECT id, month, batch FROM kept) k USING (id))"
        )
    return ",".join((first, signed, EDGES, COMPONENTS))


def _dedup_sql(scope: list[str], columns: str) -> str:
    return sql(
        f"SELECT {columns} FROM kept WHERE id NOT IN (SELECT id FROM roots)",
        "code_files", ctes=_dedup_ctes(scope), recursive=True,
    )


# Which of two identical rows is kept is not defined, so only their shared columns are compared.
Q["deduplicate"] = lambda spark, sf: _deduplicate("global")(spark, sf).drop("month_no")
SQL["deduplicate"] = _dedup_sql([], "id AS my_id, repo_name, file_name, text")
Q["deduplicate_by_month"] = _deduplicate("month")
SQL["deduplicate_by_month"] = _dedup_sql(["month"], "id AS my_id, repo_name, file_name, month_no, text")


def _added_month_by_month(spark, sf):
    """Eleven months, then the twelfth: the index is asked, and no earlier text is read again."""
    files, index = _files(spark, sf), scratch_path(spark, "near-index")
    eleven = N.add_to_index(files.where("month <= 11"), index, 1)
    last = N.add_to_index(files.where("month = 12"), index, 2)
    kept = drop_ids(eleven.kept, last.retracted, "my_id").unionByName(last.kept)
    return kept.select("my_id", "repo_name", "file_name", "text")


Q["incremental_deduplicate"] = _added_month_by_month
SQL["incremental_deduplicate"] = SQL["deduplicate"]


def _index_labels(spark, sf):
    files, index = _files(spark, sf), scratch_path(spark, "near-index")
    for run, months in enumerate(("month <= 4", "month BETWEEN 5 AND 11", "month = 12"), 1):
        N.add_to_index(files.where(months), index, run)
    return N.index_labels(spark, index)


Q["incremental_labels"] = _index_labels
SQL["incremental_labels"] = sql(
    """SELECT i.my_id AS id, coalesce(r.root, k.id) AS root
       FROM (SELECT DISTINCT my_id, text FROM identified) i JOIN kept k ON k.text = i.text LEFT JOIN roots r ON r.id = k.id""",
    "code_files", ctes=_dedup_ctes([]), recursive=True,
)


def _curate_job(spark, sf):
    """Two runs over the same folders: the first does half of the months, the second resumes."""
    deduped, filtered = scratch_path(spark, "deduped"), scratch_path(spark, "filtered")
    records = _files(spark, sf).drop("id")
    manifest = spark.createDataFrame([], "month int, batch long, stage string")
    done = jobs.curate_job(records.where("month <= 6"), manifest, deduped, filtered)
    half = done.where("month > 3 OR stage = 'deduped'")  # as if the run had stopped while filtering
    jobs.curate_job(records, half, deduped, filtered)
    schema = "my_id string, language string, loc int, alpha double, html_skipped boolean, month int, batch long"
    written = spark.read.schema(schema).json(filtered)
    return written.withColumn("alpha", F.round("alpha", 6))


Q["curate_job"] = _curate_job
SQL["curate_job"] = sql(
    f"""SELECT id AS my_id, language, loc, alpha, html_skipped, month, batch FROM (
          SELECT *, bool_or(unparsed AND xml_ok) OVER (PARTITION BY month, batch) AS html_skipped
          FROM (SELECT *, {G.LOC} AS loc, {G.ROUND_ALPHA}, {G.LOC_OK} AND {G.ALPHA_OK} AND {G.XML_OK} AS xml_ok,
                       {G.HTML_OK} AS html_ok, {G.UNPARSED} AS unparsed, {G.TOKENS_OK} AS tokens_ok
                FROM kept WHERE id NOT IN (SELECT id FROM roots)) s) t
        WHERE xml_ok AND tokens_ok AND (html_ok OR html_skipped)""",
    "code_files", ctes=_dedup_ctes(["month", "batch"]), recursive=True,
)

Q["curate"] = lambda spark, sf: jobs.curate(_files(spark, sf)).select(
    "my_id", "language", "loc", F.round("alpha", 6).alias("alpha"), "html_skipped"
)
SQL["curate"] = sql(
    f"""SELECT id AS my_id, language, {G.LOC} AS loc, {G.ROUND_ALPHA}, {G.UNPARSED} AS html_skipped FROM kept
        WHERE id NOT IN (SELECT id FROM roots) AND {G.LOC_OK} AND {G.ALPHA_OK} AND {G.XML_OK}
          AND ({G.HTML_OK} OR {G.UNPARSED}) AND {G.TOKENS_OK}""",
    "code_files", ctes=_dedup_ctes([]), recursive=True,
)


def _curate_runs(spark, sf):
    files, index, filtered = _files(spark, sf).drop("id"), scratch_path(spark, "near-index"), scratch_path(spark, "filtered")
    for run, months in enumerate(("month <= 8", "month > 8"), 1):
        jobs.curate_run(files.where(months), index, run, filtered)
    schema = "my_id string, language string, loc int, alpha double, html_skipped boolean"
    kept = jobs.curated_records(spark.read.schema(schema).option("recursiveFileLookup", True).json(filtered), index)
    return kept.withColumn("alpha", F.round("alpha", 6))


Q["curate_run"] = _curate_runs
SQL["curate_run"] = SQL["curate"]
