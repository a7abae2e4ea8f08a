"""Quality filters and their chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import sql, view
from srcsieve.constants import MIN_VISIBLE_CHARS
from srcsieve.functions import text as X
from srcsieve.operators import comments as K
from srcsieve.operators import quality as G
from srcsieve.operators.rank_tokens import rank_token_count


Q: dict = {}
SQL: dict[str, str] = {}

LOC = "CAST(len(string_split(text, chr(10))) AS INT)"
ALPHA = r"(CASE WHEN text = '' THEN NULL ELSE length(regexp_replace(text, '[^\p{L}]', '', 'g'))::DOUBLE / length(text) END)"
IS_XML = "coalesce(lower(language) = 'xml', false)"
IS_HTML = "coalesce(lower(language) = 'html', false)"
XML_OK = f"NOT ({IS_XML} AND contains(substr(text, 1, 100), '<?xml version='))"
CLEAN = r"NOT regexp_matches(text, '(<!\[[^\p{L}\p{N}_])|([\x00-\x08\x0B\x0C\x0E-\x1F])')"
VISIBLE = "text"
for pattern in (
    r"(?is)<script\b[^>]*(?:>.*?(?:</script\s*>|\z)|\z)", r"(?is)<style\b[^>]*(?:>.*?(?:</style\s*>|\z)|\z)",
    r"(?s)<!--.*?(?:-->|\z)", r"(?s)<[!/?a-zA-Z][^>]*(?:>|\z)",
):
    VISIBLE = f"regexp_replace({VISIBLE}, '{pattern}', '', 'g')"
VISIBLE = f"length(regexp_replace({VISIBLE}, '&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);', 'x', 'g'))"
VISIBLE_OK = f"({VISIBLE} > 100 AND {VISIBLE}::DOUBLE / length(text) > 0.2)"
HTML_OK = f"(NOT {IS_HTML} OR ({CLEAN} AND {VISIBLE_OK}))"
UNPARSED = f"""({IS_HTML} AND {CLEAN} AND len(list_filter(regexp_extract_all(text, '<!\\[([a-zA-Z][-_.a-zA-Z0-9]*)?', 1),
    lambda name: lower(name) NOT IN ('temp', 'cdata', 'ignore', 'include', 'rcdata', 'if', 'else', 'endif'))) > 0)"""
TOKENS = r"len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\s]'))"
TOKENS_OK = f"({TOKENS} > 0 AND length(text)::DOUBLE / {TOKENS} >= 2.5)"
LOC_OK = f"{LOC} BETWEEN 5 AND 10000"
ALPHA_OK = f"coalesce({ALPHA} >= 0.25, false)"
SCORED = f"SELECT *, {LOC} AS loc, {ALPHA} AS alpha FROM code_files"


def _files(spark, sf):
    return view(spark, sf, "code_files")


def _rounded(df):
    return df.withColumn("alpha", F.round("alpha", 6)) if "alpha" in df.columns else df


def rule(name: str, function, columns: str, where: str, source: str = "code_files") -> None:
    Q[name] = lambda spark, sf: _rounded(function(view(spark, sf, source)))
    SQL[name] = sql(f"SELECT {columns} FROM {source} WHERE {where}", source)


ROUND_ALPHA = f"round({ALPHA}, 6) AS alpha"
rule("loc_filter", G.loc_filter, f"*, {LOC} AS loc", LOC_OK)
rule("alpha_filter", G.alpha_filter, f"*, {ROUND_ALPHA}", ALPHA_OK)
rule("xml_header_filter", G.xml_header_filter, "*", XML_OK)
rule("malformed_html_filter", G.malformed_html_filter, "*", f"NOT {IS_HTML} OR {CLEAN}")
rule("html_boilerplate_filter", G.html_boilerplate_filter, "*", f"NOT {IS_HTML} OR {VISIBLE_OK}")
rule("html_boilerplate_filter_pages", G.html_boilerplate_filter, "*", f"NOT {IS_HTML} OR {VISIBLE_OK}", "html_files")
rule("html_filter_pages", G.html_filter, "*", HTML_OK, "html_files")
rule("token_fertility_filter", G.token_fertility_filter, "*", TOKENS_OK)
rule(
    "score_filter",
    lambda df: G.score_filter(df, F.length("text"), lambda n: n % 2 == 0, "n_chars"),
    "*, CAST(length(text) AS INT) AS n_chars", "length(text) % 2 = 0",
)
rule(
    "sequential",
    lambda df: G.sequential(df, G.loc_filter, G.alpha_filter, G.xml_header_filter),
    f"*, {LOC} AS loc, {ROUND_ALPHA}", f"{LOC_OK} AND {ALPHA_OK} AND {XML_OK}",
)
rule(
    "quality_filter_chain", G.quality_filter_chain, f"*, {LOC} AS loc, {ROUND_ALPHA}",
    f"{LOC_OK} AND {ALPHA_OK} AND {XML_OK} AND {HTML_OK} AND {TOKENS_OK}",
)
rule(
    "quality_filter_chain_no_html", G.quality_filter_chain_no_html, f"*, {LOC} AS loc, {ROUND_ALPHA}",
    f"{LOC_OK} AND {ALPHA_OK} AND {XML_OK} AND {TOKENS_OK}",
)
rule(
    "filter_with_fallback", G.filter_with_fallback, f"*, {LOC} AS loc, {ROUND_ALPHA}, {UNPARSED} AS html_skipped",
    f"{LOC_OK} AND {ALPHA_OK} AND {XML_OK} AND ({HTML_OK} OR {UNPARSED}) AND {TOKENS_OK}",
)

Q["visible_text_length"] = lambda spark, sf: view(spark, sf, "html_files").select(
    "id", X.visible_chars("text").alias("visible"),
    F.round(X.visible_ratio("text", MIN_VISIBLE_CHARS), 6).alias("ratio"),
)
SQL["visible_text_length"] = sql(
    f"""SELECT id, CAST({VISIBLE} AS INT) AS visible,
               CASE WHEN {VISIBLE} > 100 THEN round({VISIBLE}::DOUBLE / length(text), 6) ELSE 0.0 END AS ratio
        FROM html_files""",
    "html_files",
)

SCOPE = ("month_no", "batch")
Q["filter_with_fallback_by_file"] = lambda spark, sf: _rounded(G.filter_with_fallback(_files(spark, sf), SCOPE))
SQL["filter_with_fallback_by_file"] = sql(
    f"""SELECT * EXCLUDE (xml_ok, html_ok, tokens_ok, unparsed) FROM (
          SELECT *, bool_or(unparsed AND xml_ok) OVER (PARTITION BY month_no, batch) AS html_skipped
          FROM (SELECT *, {LOC} AS loc, {ROUND_ALPHA}, {LOC_OK} AND {ALPHA_OK} AND {XML_OK} AS xml_ok,
                       {HTML_OK} AS html_ok, {UNPARSED} AS unparsed, {TOKENS_OK} AS tokens_ok FROM code_files) s) t
        WHERE xml_ok AND tokens_ok AND (html_ok OR html_skipped)""",
    "code_files",
)

Q["filter_report"] = lambda spark, sf: G.filter_report(_files(spark, sf))
SQL["filter_report"] = sql(
    f"""SELECT count(*) AS records,
          count(*) FILTER (WHERE first = 'kept') AS kept,
          count(*) FILTER (WHERE first = 'lines') AS dropped_lines,
          count(*) FILTER (WHERE first = 'letters') AS dropped_letters,
          count(*) FILTER (WHERE first = 'xml') AS dropped_xml,
          count(*) FILTER (WHERE first = 'html') AS dropped_html,
          count(*) FILTER (WHERE first = 'tokens') AS dropped_tokens
        FROM (SELECT CASE WHEN NOT {LOC_OK} THEN 'lines' WHEN NOT {ALPHA_OK} THEN 'letters' WHEN NOT ({XML_OK}) THEN 'xml'
                     WHEN NOT {HTML_OK} THEN 'html' WHEN NOT {TOKENS_OK} THEN 'tokens' ELSE 'kept' END AS first
              FROM code_files) t""",
    "code_files",
)



# -- comments: strings are put back as group 1, comments are not, so what is missing then was comment -----------------

def _short(mark: str) -> str:
    return rf"{mark}(?:\\(?s:.)|[^{mark}\\\n])*(?:{mark}|\n|\\?\z)"


def _long(mark: str) -> str:
    return rf"{mark}(?:\\(?s:.)|[^\\])*?(?:{mark}|\\?\z)"


def _raw(mark: str) -> str:
    return rf"{mark}[^{mark}]*(?:{mark}|\z)"


SHORT = f'{_short(chr(34))}|{_short(chr(39))}'
SLASHES = r"//[^\n]*|/\*(?s:.*?)(?:\*/|\z)"
COMMENT_PATTERNS = {
    "Python": f"({_long(chr(34) * 3)}|{_long(chr(39) * 3)}|{SHORT})|#[^\\n]*",
    "JavaScript": f"({SHORT}|{_long('`')})|{SLASHES}",
    "R": f"({_long(chr(34))}|{_long(chr(39))})|#[^\\n]*",
    "XML": r"()<!--(?s:.*?)(?:-->|\z)",
    "SQL": rf"({_raw(chr(34))}|{_raw(chr(39))})|--[^\n]*|/\*(?s:.*?)(?:\*/|\z)",
    "C": f"({SHORT})|{SLASHES}",
    "Go": f"({SHORT}|{_raw('`')})|{SLASHES}",
}
COMMENT_CHARS = "CASE language " + " ".join(
    f"WHEN '{name}' THEN length(text) - length(regexp_replace(text, '{pattern.replace(chr(39), chr(39) * 2)}', '\\1', 'g'))"
    for name, pattern in COMMENT_PATTERNS.items()
) + " END"
LEXED = f"(SELECT *, {COMMENT_CHARS} AS comment_chars FROM commented_files) lexed"
COMMENT_SHARE = "CASE WHEN length(text) = 0 THEN 0.0 ELSE comment_chars::DOUBLE / length(text) END"

Q["comment_share"] = lambda spark, sf: K.comment_share(view(spark, sf, "commented_files")).select(
    "id", "language", "comment_chars", F.round("comment_share", 6).alias("comment_share")
)
SQL["comment_share"] = sql(
    f"""SELECT id, language, CAST(comment_chars AS BIGINT) AS comment_chars,
               round(CASE WHEN comment_chars IS NOT NULL THEN {COMMENT_SHARE} END, 6) AS comment_share FROM {LEXED}""",
    "commented_files",
)

Q["comment_filter"] = lambda spark, sf: K.comment_filter(view(spark, sf, "commented_files"), 0.05, 0.6).select("id", "language", "text")
SQL["comment_filter"] = sql(
    f"SELECT id, language, text FROM {LEXED} WHERE comment_chars IS NULL OR {COMMENT_SHARE} BETWEEN 0.05 AND 0.6",
    "commented_files",
)

Q["comment_share_by_language"] = lambda spark, sf: K.comment_share_by_language(
    view(spark, sf, "commented_files")
).withColumn("share", F.round("share", 6))
SQL["comment_share_by_language"] = sql(
    f"""SELECT language, count(*) AS files, CAST(sum(length(text)) AS BIGINT) AS chars,
               CAST(sum(comment_chars) AS BIGINT) AS comment_chars,
               round(coalesce(sum(comment_chars)::DOUBLE / nullif(sum(length(text)), 0), 0), 6) AS share
        FROM {LEXED} WHERE comment_chars IS NOT NULL GROUP BY 1""",
    "commented_files",
)

# -- tokens by a trained vocabulary: merges have no SQL form, the tests compare them with a library and by brute force --

BRUTE_FORCE = {"rank_token_count"}


def _ranked(spark, sf):
    import public_tokenizers

    count = rank_token_count(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return view(spark, sf, "code_files").select("id", count("text").alias("tokens"))


Q["rank_token_count"] = _ranked
