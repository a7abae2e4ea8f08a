"""The share of comments in source files, by a lexer that is a finite-state machine built from a table per language.

``LANGUAGES`` says how a language writes comments and strings. ``machine`` turns a row of it into states and moves: at
each place the longest marker that stands there counts, strings hide comments and the other way round, and block
comments nest where the language says so. Spark walks the machine over the text: a run of characters that are in no
marker is one step. All of it stays in the JVM, and the time is linear in the text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from srcsieve.operators.joins import once


@dataclass(frozen=True)
class Syntax:
    """Markers of a language. A string is ``(open, close, has escapes, ends with its line)``."""

    line: tuple[str, ...] = ()
    block: tuple[tuple[str, str], ...] = ()
    nested: bool = False
    strings: tuple[tuple[str, str, bool, bool], ...] = field(default=())


def quoted(*marks: str, escapes: bool = True, one_line: bool = True) -> tuple[tuple[str, str, bool, bool], ...]:
    return tuple((mark, mark, escapes, one_line) for mark in marks)


SHORT, RAW, LONG = quoted('"', "'"), quoted("`", escapes=False, one_line=False), quoted("`", one_line=False)
OPEN = quoted('"', one_line=False)
SLASHES = Syntax(("//",), (("/*", "*/"),), strings=SHORT)
HASH = Syntax(("#",), strings=quoted('"', "'", one_line=False))
MARKUP = Syntax(block=(("<!--", "-->"),))
LISP = Syntax((";",), strings=OPEN)
PERCENT = Syntax(("%",))

# The comment and string markers of each language, by its lower-cased name.
LANGUAGES = {
    "c": SLASHES, "c++": SLASHES, "c#": SLASHES, "java": SLASHES, "objective-c": SLASHES, "objective c": SLASHES,
    "javascript": Syntax(SLASHES.line, SLASHES.block, strings=SHORT + LONG),
    "typescript": Syntax(SLASHES.line, SLASHES.block, strings=SHORT + LONG),
    "go": Syntax(SLASHES.line, SLASHES.block, strings=SHORT + RAW),
    "php": Syntax(("//", "#"), SLASHES.block, strings=HASH.strings),
    "css": Syntax(block=SLASHES.block, strings=SHORT),
    "scss": SLASHES, "less": SLASHES, "groovy": SLASHES, "verilog": Syntax(SLASHES.line, SLASHES.block, strings=quoted('"')),
    "rust": Syntax(SLASHES.line, SLASHES.block, True, OPEN),
    "swift": Syntax(SLASHES.line, SLASHES.block, True, quoted('"') + quoted('"""', one_line=False)),
    "kotlin": Syntax(SLASHES.line, SLASHES.block, True, quoted('"') + quoted('"""', escapes=False, one_line=False)),
    "scala": Syntax(SLASHES.line, SLASHES.block, True, quoted('"') + quoted('"""', escapes=False, one_line=False)),
    "dart": Syntax(SLASHES.line, SLASHES.block, True, SHORT + quoted('"""', "'''", one_line=False)),
    "python": Syntax(("#",), strings=SHORT + quoted('"""', "'''", one_line=False)),
    "r": HASH, "ruby": HASH, "perl": HASH, "shell": HASH, "elixir": HASH, "powershell": Syntax(("#",), (("<#", "#>"),), strings=SHORT),
    "yaml": HASH, "toml": HASH, "makefile": Syntax(("#",)), "dockerfile": Syntax(("#",)), "cmake": Syntax(("#",), (("#[[", "]]"),), strings=OPEN),
    "julia": Syntax(("#",), (("#=", "=#"),), True, quoted('"', '"""', one_line=False)),
    "sql": Syntax(("--",), SLASHES.block, strings=quoted("'", '"', escapes=False, one_line=False)),
    "lua": Syntax(("--",), (("--[[", "]]"),), strings=SHORT),
    "haskell": Syntax(("--",), (("{-", "-}"),), True, quoted('"')),
    "elm": Syntax(("--",), (("{-", "-}"),), True, quoted('"')),
    "ada": Syntax(("--",), strings=quoted('"', escapes=False)), "vhdl": Syntax(("--",), strings=quoted('"', escapes=False)),
    "ocaml": Syntax(block=(("(*", "*)"),), nested=True, strings=OPEN),
    "fsharp": Syntax(("//",), (("(*", "*)"),), True, OPEN), "f#": Syntax(("//",), (("(*", "*)"),), True, OPEN),
    "pascal": Syntax(("//",), (("{", "}"), ("(*", "*)")), strings=quoted("'", escapes=False)),
    "lisp": LISP, "common lisp": LISP, "emacs lisp": LISP, "scheme": LISP, "clojure": LISP,
    "html": MARKUP, "xml": MARKUP, "tex": PERCENT, "erlang": Syntax(("%",), strings=OPEN), "matlab": PERCENT,
    "fortran": Syntax(("!",), strings=quoted('"', "'", escapes=False)), "assembly": Syntax((";",), strings=SHORT),
}

#: Files with a smaller or larger share are left out by default.
MIN_SHARE, MAX_SHARE = 0.01, 0.85

CODE, LINE = 0, 1
#: Stands for every character that is in no marker.
OTHER = "\0"
MACHINE = "tokens string, marks string, classes int, moves array<struct<to: int, add: int, deeper: int, weight: int>>, rest array<int>"


def machine(syntax: Syntax) -> tuple:
    """States and moves for ``syntax``, as a row of ``MACHINE``.

    A state is what the text is in (code, a line comment, a block, a string) with the characters read that may become a
    marker. A move gives the next state, the comment characters that are settled by it (a marker counts once it is
    whole), the change of depth, and whether further characters of a run count. ``rest`` settles a state at the end.
    """
    blocks = range(2, 2 + len(syntax.block))
    first_string = 2 + len(syntax.block)
    markers: list[dict[str, int]] = [{}, {"\n": CODE}]
    markers[CODE] |= dict.fromkeys(syntax.line, LINE)
    for mode, (start, end) in zip(blocks, syntax.block):
        markers[CODE][start] = mode
        markers.append({end: CODE} | ({start: mode} if syntax.nested else {}))
    for mode, (start, end, _, one_line) in enumerate(syntax.strings, first_string):
        markers[CODE][start] = mode
        markers.append({end: CODE} | ({"\n": CODE} if one_line else {}))
    escapes = {mode for mode, string in enumerate(syntax.strings, first_string) if string[2]}
    comment = {LINE, *blocks}

    def settle(mode: int, text: str, at_end: bool = False) -> tuple[tuple[int, str], int, int]:
        """Settle what can be told of ``text``: the state after it, comment characters, change of depth."""
        count = deeper = 0
        while text:
            if mode in escapes and text[0] == "\\" and (at_end or len(text) < 2):
                break
            if mode in escapes and text[0] == "\\":
                text = text[2:]
                continue
            if not at_end and any(m != text and m.startswith(text) for m in markers[mode]):
                break
            mark = max((m for m in markers[mode] if text.startswith(m)), key=len, default=None)
            if mark is None:
                count += mode in comment
                text = text[1:]
                continue
            target, text = markers[mode][mark], text[len(mark):]
            count += len(mark) * (target in comment or mode in blocks)
            if target in blocks or mode in blocks:
                if text:
                    raise ValueError(f"a character after the marker {mark} is read with it")
                deeper = 1 if target in blocks else -1
            mode = mode if deeper < 0 else target  # the depth tells where the end of a block leads to
        return (mode, text), count, deeper

    marks = "".join(sorted(set("\n\\").union(*(m for at in markers for m in at))))
    states, moves = [(CODE, "")], []
    for mode, pending in states:  # grows on the way
        for character in OTHER + marks:
            state, add, deeper = settle(mode, pending + character)
            if state not in states:
                states.append(state)
            moves.append((states.index(state), add, deeper, int(state[0] in comment)))
    escaped = "".join("\\n" if c == "\n" else re.escape(c) for c in marks)
    tokens = f"[{escaped}]|[^{escaped}]+"
    return tokens, marks, len(marks) + 1, moves, [settle(*state, at_end=True)[1] for state in states]


def lexers(spark: SparkSession, languages: dict[str, Syntax] | None = None) -> DataFrame:
    """One machine per lower-cased language: a few dozen rows, broadcast."""
    rows = [(name, machine(syntax)) for name, syntax in (LANGUAGES if languages is None else languages).items()]
    return F.broadcast(spark.createDataFrame(rows, f"_syntax_of string, _machine struct<{MACHINE}>"))


def _comment_chars(text: str) -> Column:
    """Characters of ``text`` that are in comments, markers included, by the machine of the row."""
    quoted_name = "`" + text.replace("`", "``") + "`"
    return F.expr(f"""
        aggregate(
            regexp_extract_all({quoted_name}, _machine.tokens, 0),
            named_struct('state', 0, 'depth', 0, 'n', 0L),
            (at, token) -> transform(
                array(_machine.moves[at.state * _machine.classes + locate(token, _machine.marks)]),
                move -> named_struct(
                    'state', if(move.deeper < 0 AND at.depth = 1, 0, move.to),
                    'depth', at.depth + move.deeper,
                    'n', at.n + move.add + (length(token) - 1) * move.weight
                )
            )[0],
            at -> at.n + _machine.rest[at.state]
        )""")


def comment_share(df: DataFrame, languages: dict[str, Syntax] | None = None) -> DataFrame:
    """Add ``comment_chars`` and ``comment_share``, the part of a file's characters that are in comments.

    Null where the language has no entry or is null, or the text is null; 0 for an empty text. Markers count as part of
    the comment, the end of its line does not. What is never closed ends with the text. A text takes some sixty bytes
    of memory per marker character. Columns of these two names are replaced.
    """
    kept = [c for c in df.columns if c not in ("comment_chars", "comment_share")]
    known = df.select(*kept).join(
        lexers(df.sparkSession, languages), F.lower("language") == F.col("_syntax_of"), "left"
    )
    counted = known.select("*", once(_comment_chars("text").cast("long").alias("comment_chars")))
    share = F.when(F.length("text") == 0, F.lit(0.0)).otherwise(F.col("comment_chars") / F.length("text"))
    return counted.select(*kept, "comment_chars", F.when(F.col("comment_chars").isNotNull(), share).alias("comment_share"))


def comment_filter(
    df: DataFrame, low: float = MIN_SHARE, high: float = MAX_SHARE, languages: dict[str, Syntax] | None = None
) -> DataFrame:
    """Keep files whose share of comments is from ``low`` to ``high``; files without a share are kept."""
    scored = comment_share(df, languages)
    return scored.where(F.coalesce(F.col("comment_share").between(low, high), F.lit(True)))


def comment_share_by_language(df: DataFrame) -> DataFrame:
    """Per language as stored: files, characters, comment characters and their share; only lexed files count."""
    scored = comment_share(df).where(F.col("comment_chars").isNotNull())
    totals = scored.groupBy("language").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(F.length("text")).cast("long").alias("chars"),
        F.sum("comment_chars").cast("long").alias("comment_chars"),
    )
    return totals.withColumn("share", F.coalesce(F.try_divide("comment_chars", "chars"), F.lit(0.0)))
