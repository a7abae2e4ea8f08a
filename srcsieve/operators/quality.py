"""Quality filters: score each record, keep those whose score passes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from srcsieve import constants as K
from srcsieve.functions import text as X
from srcsieve.operators.joins import lookup_join, once
from srcsieve.operators.rank_tokens import rank_token_count

Step = Callable[[DataFrame], DataFrame]


def score_filter(
    df: DataFrame, score: Column, keep: Callable[[Column], Column], score_col: str | None = None
) -> DataFrame:
    """Keep rows whose ``score`` passes ``keep``; store it as ``score_col`` if named.

    ``score`` is any column, a pandas UDF included; it is computed once per row. Rows with
    a null score are dropped.
    """
    name = score_col or "_score"
    others = [c for c in df.columns if c != name]
    scored = df.select(*others, once(score.alias(name))).where(keep(F.col(name)))
    return scored if score_col else scored.select(*df.columns)


def sequential(df: DataFrame, *steps: Step) -> DataFrame:
    """Apply steps in order."""
    return reduce(lambda rows, step: rows.transform(step), steps, df)


def _language_is(name: str) -> Column:
    """Null-safe: a record without a language is not of that language."""
    return F.lower("language").eqNullSafe(name)


def loc_filter(df: DataFrame, low: int = K.MIN_LINES, high: int = K.MAX_LINES) -> DataFrame:
    """Line count within bounds, both included; stores ``loc``."""
    return score_filter(df, X.line_count("text"), lambda loc: loc.between(low, high), "loc")


def alpha_filter(df: DataFrame, min_ratio: float = K.MIN_ALPHA_RATIO) -> DataFrame:
    """Enough letters among the characters; stores ``alpha``."""
    return score_filter(df, X.alpha_ratio("text"), lambda alpha: alpha >= min_ratio, "alpha")


def _xml_passes() -> Column:
    return ~_language_is("xml") | ~F.coalesce(X.has_xml_header("text", K.XML_PREFIX_CHARS), F.lit(False))


def xml_header_filter(df: DataFrame) -> DataFrame:
    """Drop XML files that open with an XML declaration."""
    return df.where(_xml_passes())


def malformed_html_filter(df: DataFrame) -> DataFrame:
    """Drop HTML files with broken markup or control characters."""
    return df.where(~_language_is("html") | ~X.has_malformed_html("text"))


def html_boilerplate_filter(
    df: DataFrame, min_ratio: float = K.MIN_VISIBLE_RATIO, min_chars: int = K.MIN_VISIBLE_CHARS
) -> DataFrame:
    """Drop HTML files with little visible text."""
    return df.where(~_language_is("html") | (X.visible_ratio("text", min_chars) > min_ratio))


def html_filter(df: DataFrame) -> DataFrame:
    """Both HTML rules."""
    return sequential(df, malformed_html_filter, html_boilerplate_filter)


def model_token_count(model_path: str) -> Callable[[Column], Column]:
    """Token counts by a SentencePiece model, loaded once per Python worker.

    The model file must be readable under this path by every executor.
    """

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        for texts in batches:
            yield texts.map(lambda text: None if text is None else len(model.encode(text)))

    return count


def _counter(tokenizer: str) -> Callable[[Column], Column]:
    """Merge ranks where the file is a list of ranks (``.tiktoken``), else a SentencePiece model."""
    if tokenizer.endswith(".tiktoken"):
        return rank_token_count(SparkSession.active(), tokenizer)
    return model_token_count(tokenizer)


def _fertility(tokenizer: str | None, reached: Column | None = None) -> Column:
    """Characters per token. A model gets only texts that ``reached`` the rule: a condition
    around a Python function does not keep it from running, so the others go in as null."""
    text = F.col("text") if reached is None else F.when(reached, F.col("text"))
    tokens = _counter(tokenizer)(text) if tokenizer else None
    return X.chars_per_token("text", tokens)


def token_fertility_filter(
    df: DataFrame, min_ratio: float = K.MIN_CHARS_PER_TOKEN, tokenizer: str | None = None
) -> DataFrame:
    """Enough characters per token; the score is not stored.

    ``tokenizer`` is the path of a SentencePiece model, or of a byte-pair vocabulary with merge ranks
    (``.tiktoken``). Without one, tokens are counted by a pattern, which only approximates a trained tokenizer.
    """
    return score_filter(df, _fertility(tokenizer), lambda ratio: ratio >= min_ratio)


def score_markup(df: DataFrame, html: bool = True) -> DataFrame:
    """Add ``loc``, ``alpha``, ``xml_ok``, ``html_failed`` and ``html_ok``.

    Each dearer score is computed only if the cheaper rules pass, and is null otherwise.
    """
    loc, alpha = F.col("loc"), F.col("alpha")
    first = df.select("*", once(X.line_count("text").alias("loc")))
    second = first.select(
        "*", once(F.when(loc.between(K.MIN_LINES, K.MAX_LINES), X.alpha_ratio("text")).alias("alpha"))
    )
    third = second.select("*", once(F.when(alpha >= K.MIN_ALPHA_RATIO, _xml_passes()).alias("xml_ok")))
    if not html:
        return third.select("*", F.lit(False).alias("html_failed"), F.col("xml_ok").alias("html_ok"))
    is_html = F.col("xml_ok") & _language_is("html")
    broken = X.has_malformed_html("text")
    visible = X.visible_ratio("text", K.MIN_VISIBLE_CHARS) > K.MIN_VISIBLE_RATIO
    return third.select(
        "*",
        once(
            F.when(is_html, ~broken & X.has_unknown_section("text")).otherwise(F.lit(False)).alias("html_failed"),
            F.when(
                F.col("xml_ok"), ~_language_is("html") | (~broken & F.coalesce(visible, F.lit(False)))
            ).alias("html_ok"),
        ),
    )


def score_tokens(scored: DataFrame, reached: Column, tokenizer: str | None = None) -> DataFrame:
    """Add ``tokens_ok`` to the rows that ``reached`` this rule, null to the others."""
    fertility = F.when(reached, _fertility(tokenizer, reached))
    return scored.select("*", once((fertility >= K.MIN_CHARS_PER_TOKEN).alias("tokens_ok")))


def score_quality(df: DataFrame, html: bool = True, tokenizer: str | None = None) -> DataFrame:
    """Add every score and rule outcome in one pass over the text."""
    return score_tokens(score_markup(df, html), F.col("html_ok") | F.col("html_failed"), tokenizer)


RULES = ["xml_ok", "html_failed", "html_ok", "tokens_ok"]


def quality_filter_chain(df: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Lines, letters, XML, HTML, tokens; stores ``loc`` and ``alpha``."""
    scored = score_quality(df, tokenizer=tokenizer)
    return scored.where(F.col("html_ok") & F.col("tokens_ok")).drop(*RULES)


def quality_filter_chain_no_html(df: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The same without the HTML rules."""
    scored = score_quality(df, html=False, tokenizer=tokenizer)
    return scored.where(F.col("tokens_ok")).drop(*RULES)


def filter_with_fallback(
    df: DataFrame, scope: tuple[str, ...] = (), tokenizer: str | None = None
) -> DataFrame:
    """The full chain, but HTML that cannot be parsed does not lose records.

    A marked section of unknown kind makes an HTML parser fail. Without ``scope`` that
    record alone skips the HTML rules, and ``html_skipped`` says so. With the columns of an
    output file as ``scope``, one such record makes its whole file skip them.
    """
    columns = [*df.columns, "loc", "alpha"]
    skipped = F.col("html_failed")
    if not scope:
        scored = score_quality(df, tokenizer=tokenizer)
    else:
        # Only HTML with such a section can make a file fail, so the first pass scores no other record.
        doubtful = df.where(_language_is("html") & X.has_unknown_section("text"))
        failed = score_markup(doubtful).where(skipped).select(*scope).distinct().withColumn("_file_failed", F.lit(True))
        skipped = F.coalesce("_file_failed", F.lit(False))
        marked = score_markup(lookup_join(df, failed, list(scope), "left"))
        scored = score_tokens(marked, F.col("html_ok") | (F.col("xml_ok") & skipped), tokenizer)
    kept = scored.where((F.col("html_ok") | skipped) & F.col("tokens_ok"))
    return kept.select(*columns, skipped.alias("html_skipped"))


def filter_report(df: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row: records kept, and records dropped by the first rule each one fails."""
    scored = score_quality(df, tokenizer=tokenizer)
    first_failed = (
        F.when(~F.coalesce(F.col("loc").between(K.MIN_LINES, K.MAX_LINES), F.lit(False)), "lines")
        .when(~F.coalesce(F.col("alpha") >= K.MIN_ALPHA_RATIO, F.lit(False)), "letters")
        .when(~F.col("xml_ok"), "xml")
        .when(~F.col("html_ok"), "html")
        .when(~F.coalesce("tokens_ok", F.lit(False)), "tokens")
        .otherwise("kept")
    )
    judged = scored.select(first_failed.alias("outcome"))
    names = ("kept", "lines", "letters", "xml", "html", "tokens")
    return judged.agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(F.col("outcome") == n).alias(n if n == "kept" else f"dropped_{n}") for n in names],
    )
