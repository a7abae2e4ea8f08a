"""The comment lexer against one that reads character by character."""

import random

import pytest
from pyspark.sql import functions as F

from srcsieve.operators import comments as C

SCHEMA = "language string, text string"


def by_character(syntax, text):
    """Comment characters, by trying every marker at each place."""
    at, count, inside, depth = 0, 0, None, 0
    strings = {s[0]: s for s in syntax.strings}
    while at < len(text):
        if inside is None:
            starts = [*syntax.line, *(b[0] for b in syntax.block), *strings]
            mark = max((m for m in starts if text.startswith(m, at)), key=len, default="")
            if mark in syntax.line:
                end = text.find("\n", at)
                end = len(text) if end < 0 else end
                count += end - at
                at = end
            elif mark:
                inside = next((b for b in syntax.block if b[0] == mark), None) or strings[mark]
                depth = 1
                count += len(mark) * (len(inside) == 2)
                at += len(mark)
            else:
                at += 1
        elif len(inside) == 2:
            if text.startswith(inside[1], at):
                depth -= 1
                at, count = at + len(inside[1]), count + len(inside[1])
                inside = inside if depth else None
            elif syntax.nested and text.startswith(inside[0], at):
                depth += 1
                at, count = at + len(inside[0]), count + len(inside[0])
            else:
                at, count = at + 1, count + 1
        elif inside[2] and text[at] == "\\":
            at += 2
        elif text.startswith(inside[1], at):
            at, inside = at + len(inside[1]), None
        else:
            inside = None if inside[3] and text[at] == "\n" else inside
            at += 1
    return count


def test_every_language_by_brute_force(spark):
    rng, rows = random.Random(5), []
    for name, syntax in C.LANGUAGES.items():
        marks = [*syntax.line, *(m for b in syntax.block for m in b), *(s[0] for s in syntax.strings)]
        pieces = marks * 2 + ["\n", "\\", " ", "word", "é𝄞", "\t"] + [c for m in marks for c in m]
        rows += [(name, "".join(rng.choices(pieces, k=rng.randrange(30)))) for _ in range(60)]
    got = C.comment_share(spark.createDataFrame(rows, SCHEMA)).collect()
    wrong = [(r.language, r.text, r.comment_chars) for r in got if r.comment_chars != by_character(C.LANGUAGES[r.language], r.text)]
    assert not wrong, wrong[:3]
    assert len(got) == len(rows) and len({r.comment_chars for r in got}) > 20
    assert all(r.comment_share == pytest.approx(r.comment_chars / len(r.text) if r.text else 0) for r in got)


def test_what_each_language_calls_a_comment(spark):
    rows = [
        ("Python", 'x = "# no" # yes\n""" # no """', 5),
        ("C", 'a /* x // */ "/*" // b\n\'"\' /* c', 10 + 4 + 4),
        ("Rust", "/* a /* b */ c */ fn f<'a>() // d", 17 + 4),
        ("C", "/* a /* b */ c */", 12),
        ("Lua", "--[[ a\nb ]] c -- d\n--", 11 + 4 + 2),
        ("JavaScript", "`// no` // y", 4),
        ("SQL", "'it''s -- no' -- y", 4),
        ("html", "<p><!-- a --- b --></p>", 16),
        ("Haskell", '{- a {- "x -} b -} "{-" -- c', 18 + 4),
    ]
    got = C.comment_share(spark.createDataFrame([r[:2] for r in rows], SCHEMA)).collect()
    assert sorted((r.text, r.comment_chars) for r in got) == sorted((r[1], r[2]) for r in rows)


def test_nulls_empty_and_long_texts_and_clashing_columns(spark):
    long = "/* " + "\\\" // 'x' * / \n" * 60_000 + "*/ x"
    rows = [("C", ""), ("C", None), (None, "// x"), ("Unheard of", "// x"), ("C", long), ("C", long)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"comment_chars": F.lit("old"), "state": F.lit(1), "token": F.lit(2), "moves": F.lit(3)})
    got = C.comment_share(df)
    assert got.columns == ["language", "text", "state", "token", "moves", "comment_chars", "comment_share"]
    assert [(r.comment_chars, r.comment_share) for r in got.where("length(text) = 0").collect()] == [(0, 0.0)]
    assert {r.comment_chars for r in got.where("length(text) > 9").collect()} == {len(long) - 2}
    assert got.where("comment_chars IS NULL AND comment_share IS NULL").count() == 3
    assert C.comment_filter(df.limit(0)).count() == 0
    assert C.comment_share_by_language(df).first().files == 3


def test_the_filter_keeps_what_it_cannot_lex(spark):
    rows = [("C", "int x;"), ("C", "int x; // the only one"), ("C", "// all of it"), ("Unheard of", "x"), ("C", None)]
    kept = C.comment_filter(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str(r.text) for r in kept) == ["None", "int x; // the only one", "x"]


def test_the_text_stays_in_the_jvm(spark):
    plan = C.comment_filter(spark.createDataFrame([("C", "x")], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "SortMergeJoin" not in plan
