"""Notebooks: JSON documents in ``text`` become the plain code of their code cells."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from srcsieve.constants import NOTEBOOK_LANGUAGE, UNKNOWN_LANGUAGE
from srcsieve.functions.text import capitalise, is_blank, strip_notebook_magics
from srcsieve.operators.joins import once
from srcsieve.schema import JSON_OPTIONS as READ_OPTIONS

#: Only these parts are read; cell outputs, often most of the bytes, are skipped. ``source``
#: is a string or a list of strings, and a string may look like a list, so it is a variant.
NOTEBOOK = """array<struct<
    cells: array<struct<cell_type: string, source: variant>>,
    metadata: struct<language_info: variant, kernelspec: variant>,
    kernelspec: variant>>"""
JSON_OPTIONS = {"allowSingleQuotes": "false", **READ_OPTIONS}

MALFORMED = "malformed notebook"
NO_LANGUAGE = "no language"
KERNEL_NAME = "language from kernel name"


def is_notebook() -> Column:
    return F.col("language").eqNullSafe(NOTEBOOK_LANGUAGE)


def _has_text() -> Column:
    return F.col("text").isNotNull() & ~is_blank("text")


def split_notebooks(df: DataFrame) -> DataFrame:
    """Add ``is_notebook``; notebooks of white space only are dropped."""
    return df.where(~is_notebook() | _has_text()).withColumn("is_notebook", is_notebook())


def _parsed(text: Column) -> Column:
    """The notebook in ``text``, or null if that is not one JSON object.

    Inside brackets, text after the object is an error and a second object is counted.
    """
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), NOTEBOOK, JSON_OPTIONS)


def _open(notebooks: Column) -> Column:
    return F.when(F.size(notebooks) == 1, F.get(notebooks, F.lit(0)))


def _named(spec):
    return {k: spec[k] for k in ("name", "language") if k in spec} if isinstance(spec, dict) else spec


def read_parts(text: str | None) -> str | None:
    """The parts of a notebook that are used, as JSON again, by the standard parser; null if it fails."""
    try:
        whole = json.loads(text or "", parse_int=str)
        metadata = whole.get("metadata") or {}
        kept = {
            "cells": [{k: cell[k] for k in ("cell_type", "source") if k in cell} for cell in whole.get("cells") or []],
            "metadata": {k: _named(metadata[k]) for k in ("language_info", "kernelspec") if k in metadata},
        }
        if "kernelspec" in whole:
            kept["kernelspec"] = _named(whole["kernelspec"])
        return json.dumps(kept)
    except (ValueError, TypeError, AttributeError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def _read_again(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(read_parts)


def parse_notebook(df: DataFrame) -> DataFrame:
    """Add ``nb``, the parsed notebook; null for malformed ones and for other files.

    The JVM's parser refuses names beyond a length and repeated names, which may stand in parts
    that are never used. Texts it refuses, and no others, are read again by the standard parser, in a
    branch of their own: no other row passes through Python.
    """
    first = df.select("*", once(F.when(is_notebook() & _has_text(), _parsed(F.col("text"))).alias("_nbs")))
    opened = first.select(*df.columns, once(_open(F.col("_nbs")).alias("nb")))
    lost = F.col("nb")["metadata"]["language_info"].isNull() & F.contains("text", F.lit('"language_info"'))
    refused = F.coalesce(is_notebook() & _has_text() & (F.col("nb").isNull() | lost), F.lit(False))
    again = opened.where(refused).withColumn("_again", _read_again("text"))
    second = F.when(F.col("_again").isNotNull(), _open(_parsed(F.col("_again")))).otherwise(F.col("nb"))
    return opened.where(~refused).unionByName(again.select(*df.columns, once(second.alias("nb"))))


def _source_text(source: Column) -> Column:
    kind = F.schema_of_variant(source)
    return (
        F.when(source.isNull(), "")
        .when(F.is_variant_null(source), "None")
        .when(F.startswith(kind, F.lit("ARRAY")), F.array_join(source.cast("array<string>"), ""))
        .when(kind == "BOOLEAN", capitalise(source.cast("string")))
        .otherwise(source.cast("string"))
    )


def code_cells(nb: Column) -> Column:
    """Source of each code cell; a list of lines is joined as it stands."""
    code = F.filter(nb["cells"], lambda cell: cell["cell_type"] == "code")
    return F.transform(code, lambda cell: _source_text(cell["source"]))


def notebook_code_cells(df: DataFrame) -> DataFrame:
    """Notebooks with ``cells``, the source of their code cells in order."""
    parsed = parse_notebook(df).where(F.col("nb").isNotNull())
    return parsed.select(*df.columns, code_cells(F.col("nb")).alias("cells"))


def _code_text(nb: Column) -> Column:
    cells = F.transform(code_cells(nb), strip_notebook_magics)
    code = F.array_join(F.filter(cells, lambda cell: ~is_blank(cell)), "\n")
    return F.nullif(code, F.lit(""))


def notebook_code_text(df: DataFrame) -> DataFrame:
    """Notebooks with their code as ``text``; those without code are dropped."""
    parsed = parse_notebook(df).where(F.col("nb").isNotNull())
    others = [c for c in df.columns if c != "text"]
    coded = parsed.select(*others, once(_code_text(F.col("nb")).alias("text")))
    return coded.where(F.col("text").isNotNull()).select(*df.columns)


def _spec_field(nb: Column, place: str, field: str) -> Column:
    top = F.try_variant_get(nb["kernelspec"], f"$.{field}", "string")
    inner = F.try_variant_get(nb["metadata"]["kernelspec"], f"$.{field}", "string")
    return {"top": top, "metadata": inner, "both": F.coalesce(top, inner)}[place]


def _language(nb: Column, kernelspec: str) -> tuple[Column, Column]:
    info = nb["metadata"]["language_info"]
    name = F.coalesce(F.try_variant_get(info, "$.name", "string"), F.lit(UNKNOWN_LANGUAGE))
    spec_language = _spec_field(nb, kernelspec, "language")
    spec_name = _spec_field(nb, kernelspec, "name")
    chosen = F.when(info.isNotNull(), name).otherwise(F.coalesce(spec_language, spec_name))
    from_name = info.isNull() & spec_language.isNull() & spec_name.isNotNull()
    return capitalise(chosen), from_name


def judge_notebooks(df: DataFrame, kernelspec: str = "top") -> DataFrame:
    """Add ``code``, ``code_language`` and ``issue`` to notebooks; other files get nulls.

    ``kernelspec`` names where it is looked for: at the ``top`` of the notebook, in its
    ``metadata``, or ``both`` in that order. A notebook without code has no issue, since
    code is looked for before the language.
    """
    nb = F.col("nb")
    language, from_name = _language(nb, kernelspec)
    routed = split_notebooks(df)
    parsed = parse_notebook(routed)
    read = parsed.select(
        *routed.columns,
        once(
            nb.isNull().alias("_bad"),
            _code_text(nb).alias("code"),
            language.alias("code_language"),
            F.coalesce(from_name, F.lit(False)).alias("_from_name"),
        ),
    )
    issue = F.when(
        F.col("is_notebook"),
        F.when(F.col("_bad"), MALFORMED)
        .when(F.col("code").isNull(), F.lit(None))
        .when(F.col("code_language").isNull(), NO_LANGUAGE)
        .when(F.col("_from_name"), KERNEL_NAME),
    )
    return read.withColumn("issue", issue).withColumn(
        "no_code", F.col("is_notebook") & ~F.col("_bad") & F.col("code").isNull()
    ).drop("_bad", "_from_name")


def notebook_language(df: DataFrame, kernelspec: str = "top") -> DataFrame:
    """Notebooks with ``language`` read from inside them; null where they name none."""
    language, _ = _language(F.col("nb"), kernelspec)
    others = [c for c in df.columns if c != "language"]
    parsed = parse_notebook(df).where(F.col("nb").isNotNull())
    return parsed.select(*others, language.alias("language")).select(*df.columns)


def process_notebooks(df: DataFrame, kernelspec: str = "top") -> DataFrame:
    """Replace notebooks by their code and its language; other files pass unchanged.

    Dropped: blank, malformed, without code, without language. One narrow stage.
    """
    judged = judge_notebooks(df, kernelspec)
    kept = judged.where(~F.col("is_notebook") | (F.col("code").isNotNull() & F.col("code_language").isNotNull()))
    replaced = {"text": F.col("code"), "language": F.col("code_language")}
    return kept.select(
        *[F.when(F.col("is_notebook"), replaced[c]).otherwise(F.col(c)).alias(c) if c in replaced else c for c in df.columns]
    )


def notebook_issues(df: DataFrame, keys: list[str], kernelspec: str = "top") -> DataFrame:
    """The log: one row per notebook that is malformed, without language, or doubtful."""
    return judge_notebooks(df, kernelspec).where(F.col("issue").isNotNull()).select(*keys, "issue")


def empty_notebook_count(df: DataFrame, by: list[str]) -> DataFrame:
    """Notebooks dropped for having no code, per ``by`` group."""
    return judge_notebooks(df).groupBy(*by).agg(F.count_if("no_code").alias("empty_notebooks"))
