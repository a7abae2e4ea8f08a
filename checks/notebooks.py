"""Notebooks: built from conversations, checked against SQL that never sees their JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import sql, table, view
from srcsieve.functions.text import strip_notebook_magics
from srcsieve.operators import notebooks as N
from srcsieve.plans import jobs

Q: dict = {}
SQL: dict[str, str] = {}

# Assistant turns are code cells; the first line of some is a magic command.
CELL = "CASE WHEN conv_id % 6 = 5 THEN '%matplotlib inline' || chr(10) || '  !ls' || chr(10) || text ELSE text END"
OTHER = "conv_id % 7 = 0"
BROKEN = "conv_id % 10 = 9"
BLANK = "conv_id % 13 = 4"


def notebook_files(spark, sf):
    """One record per conversation: a notebook, a broken or blank one, or another file."""
    turns = table(spark, sf, "conversations").selectExpr("conv_id", "turn", "role", f"{CELL} AS code")
    # On even conversations the source is a list of lines, on odd ones a string.
    lines = F.split("code", "(?<=\n)")
    body = F.when(F.col("conv_id") % 2 == 0, F.to_json(lines)).otherwise(F.get(F.split(F.to_json(F.array("code")), "^\\[|\\]$"), F.lit(1)))
    kind = F.when(F.col("role") == "assistant", "code").otherwise("markdown")
    cell = F.concat(F.lit('{"cell_type": "'), kind, F.lit('", "outputs": [], "source": '), body, F.lit("}"))
    cells = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", cell.alias("cell")))).alias("cells"))
    text = F.concat(F.lit('{"cells": ['), F.array_join("cells.cell", ", "), F.lit("]"), F.expr("""
        CASE WHEN conv_id % 8 = 3 THEN ', "metadata": {"kernelspec": {"language": "R"}}, "kernelspec": {"name": "python3"}'
             WHEN conv_id % 8 = 7 THEN ', "metadata": {"kernelspec": {"name": "ir"}}'
             WHEN conv_id % 8 = 6 THEN ', "metadata": {"language_info": {}}'
             WHEN conv_id % 8 = 5 THEN ', "kernelspec": {"language": "julia", "name": "julia-1"}'
             ELSE ', "metadata": {"language_info": {"name": "javaScript"}}' END"""), F.lit("}"))
    routed = F.expr(f"CASE WHEN {BROKEN} THEN 1 WHEN {BLANK} THEN 2 END")
    return cells.select(
        "conv_id",
        (F.col("conv_id") % 12 + 1).alias("month_no"),
        F.when(F.expr(OTHER), "Python").otherwise("Jupyter Notebook").alias("language"),
        F.when(routed == 1, F.substr(text, F.lit(1), F.length(text) - 9)).when(routed == 2, " \n\t ").otherwise(text).alias("text"),
    )


BREAK = r"\r\n|[\n\x0B\f\r\x1C-\x1E\x{85}\x{2028}\x{2029}]"
SPACE = r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def cleaned(text: str) -> str:
    """Oracle form of the magic stripping: split, keep, join."""
    return (
        f"array_to_string(list_filter(string_split_regex(regexp_replace({text}, '(?:{BREAK})\\z', ''), '{BREAK}'), "
        f"lambda line: NOT regexp_matches(line, '^[{SPACE}]*[%!]')), chr(10))"
    )


TURNS = f"turns AS (SELECT conv_id, turn, role, {CELL} AS code FROM conversations)"
CODE = f"""{TURNS},
cleaned_turns AS (SELECT conv_id, turn, {cleaned('code')} AS code FROM turns WHERE role = 'assistant'),
coded AS (SELECT conv_id, string_agg(code, chr(10) ORDER BY turn) AS code FROM cleaned_turns
          WHERE regexp_matches(code, '[^{SPACE}]') GROUP BY conv_id),
judged AS (SELECT DISTINCT c.conv_id, c.conv_id % 12 + 1 AS month_no, coded.code,
    CASE c.conv_id % 8 WHEN 3 THEN 'Python3' WHEN 7 THEN NULL WHEN 6 THEN 'Unknown' WHEN 5 THEN 'Julia'
         ELSE 'Javascript' END AS lang
  FROM conversations c LEFT JOIN coded USING (conv_id))"""
NOTEBOOK = f"NOT ({OTHER}) AND NOT ({BLANK} AND NOT {BROKEN})"

Q["split_notebooks"] = lambda spark, sf: N.split_notebooks(notebook_files(spark, sf)).select("conv_id", "is_notebook")
SQL["split_notebooks"] = f"""SELECT DISTINCT conv_id, NOT ({OTHER}) AS is_notebook FROM conversations
    WHERE {OTHER} OR NOT ({BLANK} AND NOT {BROKEN})"""

Q["parse_notebook"] = lambda spark, sf: N.parse_notebook(notebook_files(spark, sf)).select(
    "conv_id", F.coalesce(F.size("nb.cells"), F.lit(-1)).alias("cells")
)
SQL["parse_notebook"] = f"""SELECT conv_id, CASE WHEN {NOTEBOOK} AND NOT {BROKEN} THEN CAST(count(*) AS INT) ELSE -1 END AS cells
    FROM conversations GROUP BY conv_id"""

Q["notebook_code_cells"] = lambda spark, sf: N.notebook_code_cells(notebook_files(spark, sf)).select(
    "conv_id", F.posexplode("cells").alias("place", "source")
)
SQL["notebook_code_cells"] = f"""WITH {TURNS}
    SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS place, code AS source
    FROM turns WHERE role = 'assistant' AND {NOTEBOOK} AND NOT {BROKEN}"""

MARKED = "chr(10) || ' ' || chr(9) || '!x' || chr(13) || chr(10) || text || chr(11) || '%y' || chr(12) || replace(text, ' ', chr(8232)) || chr(13)"


def _strip(spark, sf):
    view(spark, sf, "near_docs")
    text = F.concat(
        F.lit("\n \t!x\r\n"), "text", F.lit("\x0b%y\x0c"), F.replace("text", F.lit(" "), F.lit(" ")), F.lit("\r")
    )
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", strip_notebook_magics(text).alias("text"))


Q["strip_notebook_magics"] = _strip
SQL["strip_notebook_magics"] = f"SELECT doc_id, {cleaned('marked')} AS text FROM (SELECT doc_id, {MARKED} AS marked FROM documents) t"

Q["notebook_code_text"] = lambda spark, sf: N.notebook_code_text(notebook_files(spark, sf)).select("conv_id", "text")
SQL["notebook_code_text"] = f"""WITH {CODE} SELECT conv_id, code AS text FROM judged
    WHERE code IS NOT NULL AND {NOTEBOOK} AND NOT {BROKEN}"""

Q["notebook_language"] = lambda spark, sf: N.notebook_language(notebook_files(spark, sf)).select("conv_id", "language")
SQL["notebook_language"] = f"WITH {CODE} SELECT conv_id, lang AS language FROM judged WHERE {NOTEBOOK} AND NOT {BROKEN}"

Q["notebook_language_metadata"] = lambda spark, sf: N.notebook_language(notebook_files(spark, sf), "both").select(
    "conv_id", "language"
)
SQL["notebook_language_metadata"] = f"""WITH {CODE}
    SELECT conv_id, CASE conv_id % 8 WHEN 3 THEN 'R' WHEN 7 THEN 'Ir' ELSE lang END AS language
    FROM judged WHERE {NOTEBOOK} AND NOT {BROKEN}"""

# Other files keep their text, which SQL cannot rebuild: it is compared with what went in.
Q["process_notebooks"] = lambda spark, sf: jobs.process_months(
    notebook_files(spark, sf).withColumn("was", F.col("text"))
).select(
    "conv_id", "month_no", "language", F.when(~F.expr(OTHER), F.col("text")).alias("text"),
    F.when(F.expr(OTHER), F.col("text").eqNullSafe(F.col("was"))).alias("unchanged"),
)
SQL["process_notebooks"] = f"""WITH {CODE}
    SELECT conv_id, month_no, CASE WHEN {OTHER} THEN 'Python' ELSE lang END AS language,
           CASE WHEN NOT ({OTHER}) THEN code END AS text, CASE WHEN {OTHER} THEN TRUE END AS unchanged
    FROM judged WHERE {OTHER} OR ({NOTEBOOK} AND NOT {BROKEN} AND code IS NOT NULL AND lang IS NOT NULL)"""
Q["monthly_notebook_job"] = lambda spark, sf: jobs.process_months(notebook_files(spark, sf), "both").groupBy(
    "month_no", "language"
).agg(F.count(F.lit(1)).alias("files"))
SQL["monthly_notebook_job"] = f"""WITH {CODE}
    SELECT month_no, CASE WHEN {OTHER} THEN 'Python' WHEN conv_id % 8 = 3 THEN 'R' WHEN conv_id % 8 = 7 THEN 'Ir' ELSE lang END AS language,
           count(*) AS files
    FROM judged WHERE {OTHER} OR ({NOTEBOOK} AND NOT {BROKEN} AND code IS NOT NULL) GROUP BY 1, 2"""

Q["notebook_issues"] = lambda spark, sf: N.notebook_issues(notebook_files(spark, sf), ["conv_id", "month_no"])
SQL["notebook_issues"] = f"""WITH {CODE}
    SELECT conv_id, month_no, CASE WHEN {BROKEN} THEN '{N.MALFORMED}' WHEN lang IS NULL THEN '{N.NO_LANGUAGE}'
           ELSE '{N.KERNEL_NAME}' END AS issue
    FROM judged WHERE {NOTEBOOK} AND ({BROKEN} OR (code IS NOT NULL AND (lang IS NULL OR conv_id % 8 = 3)))"""

Q["empty_notebook_count"] = lambda spark, sf: N.empty_notebook_count(notebook_files(spark, sf), ["month_no"])
SQL["empty_notebook_count"] = f"""WITH {CODE}
    SELECT month_no, count(*) FILTER (WHERE NOT ({OTHER}) AND NOT {BROKEN} AND code IS NULL) AS empty_notebooks
    FROM judged WHERE {OTHER} OR {NOTEBOOK} GROUP BY month_no"""
