"""License notices by an exact set-similarity join, native throughout.

A text block is a line. A template is found in every block that holds at least ``threshold`` of
the template's distinct words. Only words of templates can count, so blocks are reduced to
them in the scan. Template words are ordered by their global frequency, rarest first; a block
above the threshold must hold one of the first ``size - required + 1``, its prefix. Blocks meet
templates on prefix words, the length and positional filters drop pairs that cannot reach the
required overlap, and the rest is counted exactly.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from srcsieve.llm.common import LOWER_LETTERS, UPPER_LETTERS
from srcsieve.llm.text_stats import bound
from srcsieve.session import materialise

THRESHOLD = 0.8
#: Fixed phrases and the label each stands for.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: A block is so many consecutive lines, since notices are wrapped; one starts at every line.
BLOCK_LINES = 3
#: Sentences of common notices and the label each stands for. Words after a ``*`` tell a notice from similar ones, so a
#: block must hold them. A notice that holds all words of another has both labels: a Lesser GPL one is also ``gpl``.
TEMPLATES = (
    ("mit", "permission is hereby *granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the *mit license"),
    ("mit", "licensed under the *mit license"),
    ("apache-2", "licensed under the *apache license version 2 0"),
    ("bsd", "*redistribution and use in source and *binary forms with or without modification are permitted"),
    ("bsd", "released under the *bsd license"),
    ("bsd", "licensed under the *bsd license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the *gnu general public license"),
    ("gpl", "licensed under the *gnu *general public license version"),
    ("lgpl", "under the terms of the gnu *lesser general public license"),
    ("lgpl", "licensed under the gnu *lesser general public license version"),
    ("mpl-2", "this source code form is subject to the terms of the *mozilla public license"),
    ("mpl-2", "licensed under the *mozilla public license version"),
    ("cc-by", "licensed under a creative commons *attribution international license"),
    ("cc-by-nc", "licensed under a creative commons attribution *noncommercial license"),
    ("cc-by-sa", "licensed under a creative commons attribution *sharealike license"),
    ("proprietary", "all rights *reserved no part of this may be *reproduced without permission"),
)
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased. Other letters may change, but none becomes an ASCII letter."""
    return F.lower(F.replace(text, F.lit("K"), F.lit("é")))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _APART), lambda w: w != "")


def _starts(words: Column, phrase: str) -> Column:
    parts = phrase.split(" ")
    places = F.sequence(F.lit(0), F.size(words) - len(parts))

    def here(i: Column) -> Column:
        same = F.lit(True)
        for k, part in enumerate(parts):
            same = same & (F.get(words, i + k) == part)
        return same

    return F.when(F.size(words) >= len(parts), F.filter(places, here)).otherwise(F.array().cast("array<int>"))


def _phrase_pattern() -> str:
    return "|".join(_APART.join(phrase.split(" ")) for phrase in PHRASES)


def _read(templates: tuple[tuple[str, str], ...]) -> list[tuple[str, list[str], list[str]]]:
    """``(label, distinct words, telling words)`` of each template."""
    plain = [(label, notice.split(" ")) for label, notice in templates]
    return [
        (label, sorted({w.lstrip("*") for w in words}), sorted({w[1:] for w in words if w.startswith("*")}))
        for label, words in plain
    ]


def _scan(docs: DataFrame, id_col: str, text_col: str, templates: list[tuple], least: int) -> DataFrame:
    """Per row its words, places of each phrase, and the blocks with ``least`` template words or more.

    A block that starts with a line without any holds no more than the next block, and is left out.
    """
    vocabulary = sorted({w for entry in templates for w in entry[1]})
    text = lower_ascii(F.coalesce(docs[text_col], F.lit("")))
    low = docs.select(docs[id_col].alias(id_col), text.alias("text"))
    lines = F.transform(F.split("text", "\n", -1), _words)
    # Words are flattened once per text; a lambda that names the expression would do so at every place.
    places = bound(
        F.flatten("lines"), lambda words: F.struct(*[_starts(words, p).alias(f"p{i}") for i, p in enumerate(PHRASES)])
    )
    nowhere = F.struct(*[F.array().cast("array<int>").alias(f"p{i}") for i in range(len(PHRASES))])
    of_lines = F.transform("lines", lambda words: F.array_distinct(F.filter(words, lambda w: w.isin(*vocabulary))))
    blocks = bound(of_lines, lambda told: F.filter(
        F.transform(told, lambda words, i: F.struct(
            i.alias("block"),
            F.when(F.size(words) > 0, F.array_distinct(F.flatten(F.slice(told, i + 1, F.lit(BLOCK_LINES)))))
            .otherwise(words).alias("words"),
        )),
        lambda b: F.size(b["words"]) >= least,
    ))
    return low.withColumn("lines", lines).select(
        id_col,
        F.monotonically_increasing_id().alias("row"),
        F.aggregate("lines", F.lit(0).cast("long"), lambda n, words: n + F.size(words)).alias("n_words"),
        F.when(F.col("text").rlike(_phrase_pattern()), places).otherwise(nowhere).alias("places"),
        blocks.alias("blocks"),
    )


def _template_index(templates: list[tuple], frequency: dict[str, int], threshold: float) -> list[tuple]:
    """``(word, template, position, size, required)`` for the prefix words of each template."""
    rows = []
    for number, (_, words, *_) in enumerate(templates):
        ordered = sorted(words, key=lambda w: (frequency.get(w, 0), w))
        required = ceil(threshold * len(words) - 1e-9)
        rows += [(w, number, i, len(words), required) for i, w in enumerate(ordered[: len(words) - required + 1])]
    return rows


def contained_templates(blocks: DataFrame, templates: list[tuple], threshold: float = THRESHOLD) -> DataFrame:
    """``(row, block, template, overlap)`` for every block that holds ``threshold`` of a template.

    A template is ``(label, distinct words)`` or ``(label, distinct words, words it must not lack)``.
    ``blocks`` has ``row, block`` and the distinct template words of each block as ``words``.
    What reaches the driver or is broadcast is bounded by the templates.
    """
    spark = blocks.sparkSession
    counted = blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    frequency = {row["word"]: row["n"] for row in counted.collect()}
    order = sorted({w for entry in templates for w in entry[1]}, key=lambda w: (frequency.get(w, 0), w))
    rank = F.create_map(*[F.lit(v) for i, w in enumerate(order) for v in (w, i)])
    index = spark.createDataFrame(
        _template_index(templates, frequency, threshold),
        "word string, template int, position int, size int, required int",
    )
    ordered = F.transform(
        F.sort_array(F.transform("words", lambda w: F.struct(rank[w].alias("rank"), w.alias("word")))),
        lambda e: e["word"],
    )
    listed = blocks.select("row", "block", ordered.alias("words"))
    probes = listed.select("row", "block", "words", F.posexplode("words").alias("place", "word"))
    met = probes.join(F.broadcast(index), "word").where(
        (F.size("words") >= F.col("required"))  # length
        & (F.least(F.col("size") - F.col("position"), F.size("words") - F.col("place")) >= 1)
    )
    # Position: after the first shared word both sides must still hold the required overlap.
    first = met.groupBy("row", "block", "template").agg(
        F.min("place").alias("place"), F.min("position").alias("position"),
        F.first("words").alias("words"), F.first("size").alias("size"), F.first("required").alias("required"),
    )
    possible = first.where(
        F.least(F.col("size") - F.col("position"), F.size("words") - F.col("place")) >= F.col("required")
    )
    sets = spark.createDataFrame(
        [(i, words, [w for needed in telling for w in needed]) for i, (_, words, *telling) in enumerate(templates)],
        "template int, held array<string>, telling array<string>",
    )
    shared = possible.join(F.broadcast(sets), "template").withColumn(
        "overlap", F.size(F.array_intersect("words", "held"))
    )
    whole = (F.col("overlap") >= F.col("required")) & (F.size(F.array_except("telling", "words")) == 0)
    return shared.where(whole).select("row", "block", "template", "overlap", "size")


def license_labels(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of every row.

    ``score`` is 1 where a phrase stands, else the largest share of a template found in ``BLOCK_LINES``
    consecutive lines, else 0. Words are runs of ASCII letters, digits and other characters beyond ASCII. Null texts
    are empty; repeated rows and null ids each come back; other columns are dropped.
    """
    split = _read(templates)
    least = min(ceil(threshold * len(words) - 1e-9) for _, words, _ in split)
    scanned = materialise(_scan(docs, id_col, text_col, split, least), "license-scan")
    blocks = scanned.select("row", F.inline("blocks"))
    found = contained_templates(blocks, split, threshold)
    names = F.create_map(*[F.lit(v) for i, (label, *_) in enumerate(split) for v in (i, label)])
    by_row = found.groupBy("row").agg(
        F.collect_set(names[F.col("template")]).alias("found"), F.max(F.col("overlap") / F.col("size")).alias("share")
    )
    every = F.flatten(F.array(*[F.col("places")[f"p{i}"] for i in range(len(PHRASES))]))
    base = F.array_compact(
        F.array(*[F.when(F.size(F.col("places")[f"p{i}"]) > 0, F.lit(v)) for i, v in enumerate(PHRASES.values())])
    )
    none = F.array().cast("array<string>")
    text = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    return scanned.join(by_row, "row", "left").select(
        id_col,
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        text(base).alias("base_labels"),
        text(F.concat(base, F.coalesce("found", none))).alias("labels"),
        F.when(F.size(every) > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def oracle_sql(templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for the rows of ``license_labels`` over ``documents``."""
    words = lambda t: "regexp_extract_all(" + t + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    listed = lambda t: "[" + ", ".join(f"'{w}'" for w in t) + "]"
    phrases = ", ".join(f"({i}, '{v}', {listed(p.split(' '))})" for i, (p, v) in enumerate(PHRASES.items()))
    sets = ", ".join(f"('{label}', {listed(t)}, {listed(needed)}::VARCHAR[])" for label, t, needed in _read(templates))
    return f"""
WITH low AS (
  SELECT doc_id, translate(coalesce(text, ''), '{UPPER_LETTERS}', '{LOWER_LETTERS}') AS text FROM documents),
worded AS (SELECT doc_id, text, {words("text")} AS w FROM low),
phrases(nr, label, p) AS (VALUES {phrases}),
templates(label, t, needed) AS (VALUES {sets}),
places AS (
  SELECT doc_id, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + len(p)] = p)) AS start
  FROM worded, phrases WHERE list_has_all(w, p)),
base AS (
  SELECT doc_id, count(*) AS n, min(start) AS first_word, max(start) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places GROUP BY doc_id),
lines AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM low),
joined AS (
  SELECT doc_id, unnest(list_transform(range(1, len(l) + 1), lambda i: array_to_string(l[i:i + {BLOCK_LINES - 1}], chr(10)))) AS block
  FROM lines),
blocks AS (SELECT doc_id, list_distinct({words("block")}) AS b FROM joined),
held AS (
  SELECT doc_id, label, len(list_intersect(b, t)) / len(t) AS share FROM blocks, templates
  WHERE len(list_intersect(b, t)) >= ceil({threshold} * len(t) - 1e-9) AND list_has_all(b, needed)),
best AS (SELECT doc_id, max(share) AS share FROM held GROUP BY doc_id),
every AS (
  SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM held UNION SELECT doc_id, label FROM places) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base,
       first_word, last_word, coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM worded LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN every USING (doc_id)
"""
