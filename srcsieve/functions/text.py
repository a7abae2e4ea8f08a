"""Text expressions. All run in the JVM, inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Line boundaries and white space as Python's ``str`` methods see them.
LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1C-\x1E\x{85}\x{2028}\x{2029}]"
WHITE_SPACE = r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
IN_LINE_SPACE = r"\t\x1F\x20\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"

SUFFIX = r"[^/](\.[^./]+)\z"

#: Default pre-token: a run of word characters, or one other visible character.
WORD_RUN = r"[A-Za-z0-9_]+"
SPACE_RUN = r"[ \t\n\f\r]+"

MALFORMED_HTML = r"(<!\[[^\p{L}\p{N}_])|([\x00-\x08\x0B\x0C\x0E-\x1F])"

#: Applied in order: script bodies may hold text that looks like a tag. What is never closed
#: ends with the text, so no opening is scanned for in vain over and over.
HTML_REMOVALS = (
    r"(?is)<script\b[^>]*+(?:>.*?(?:</script\s*>|\z)|\z)",
    r"(?is)<style\b[^>]*+(?:>.*?(?:</style\s*>|\z)|\z)",
    r"(?s)<!--.*?(?:-->|\z)",
    r"(?s)<[!/?a-zA-Z][^>]*+(?:>|\z)",
)
HTML_ENTITY = r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"

#: Marked sections ``<![name`` an HTML parser knows; any other name is a parse error.
MARKED_SECTION = r"<!\[([a-zA-Z][-_.a-zA-Z0-9]*)?"
KNOWN_SECTIONS = ("temp", "cdata", "ignore", "include", "rcdata", "if", "else", "endif")


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def file_suffix(file_name: Column | str) -> Column:
    """Last suffix in lower case; bare dotfiles have none."""
    return F.lower(F.regexp_extract(_col(file_name), SUFFIX, 1))


def is_blank(text: Column | str) -> Column:
    """True for text of white space only."""
    return ~F.regexp_like(_col(text), F.lit(f"[^{WHITE_SPACE}]"))


def capitalise(word: Column | str) -> Column:
    """First letter upper, all others lower (``initcap`` would raise every word)."""
    word = _col(word)
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substr(word, F.lit(2))))


def strip_notebook_magics(code: Column | str) -> Column:
    """Drop lines that start with ``%`` or ``!`` after leading white space.

    Line breaks become ``\\n`` and a final one is lost. A leading ``\\n`` lets one pattern
    take a line together with the break before it.
    """
    body = F.regexp_replace(_col(code), rf"(?:{LINE_BREAK})\z", "")
    lines = F.regexp_replace(F.concat(F.lit("\n"), body), LINE_BREAK, "\n")
    kept = F.regexp_replace(lines, rf"\n[{IN_LINE_SPACE}]*[%!][^\n]*", "")
    return F.substr(kept, F.lit(2))


def line_count(text: Column | str) -> Column:
    """Newlines plus one."""
    text = _col(text)
    newlines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return (newlines + 1).cast("int")


def alpha_ratio(text: Column | str) -> Column:
    """Share of letters among characters; null for empty text."""
    text = _col(text)
    others = F.length(F.regexp_replace(text, r"\p{L}+", ""))
    return F.try_divide((F.length(text) - others).cast("double"), F.length(text).cast("double"))


def has_xml_header(text: Column | str, prefix_chars: int) -> Column:
    return F.instr(F.substring(_col(text), 1, prefix_chars), "<?xml version=") > 0


def has_malformed_html(text: Column | str) -> Column:
    return F.regexp_like(F.coalesce(_col(text), F.lit("")), F.lit(MALFORMED_HTML))


def has_unknown_section(text: Column | str) -> Column:
    """True if HTML holds a marked section that makes a parser give up."""
    names = F.regexp_extract_all(_col(text), F.lit(MARKED_SECTION), F.lit(1))
    return F.exists(names, lambda name: ~F.lower(name).isin(*KNOWN_SECTIONS))


def visible_chars(html: Column | str) -> Column:
    """Length of the text a reader sees: no scripts, styles, comments or tags."""
    text = _col(html)
    for pattern in HTML_REMOVALS:
        text = F.regexp_replace(text, pattern, "")
    return F.length(F.regexp_replace(text, HTML_ENTITY, "x"))


def visible_ratio(html: Column | str, min_chars: int) -> Column:
    """Visible share of the source, or 0 for text of ``min_chars`` or fewer."""
    html = _col(html)
    shown = visible_chars(html)
    ratio = F.try_divide(shown.cast("double"), F.length(html).cast("double"))
    return F.when(shown > min_chars, ratio).otherwise(F.when(shown.isNotNull(), F.lit(0.0)))


def token_count(text: Column | str) -> Column:
    """Number of default pre-tokens: each word run becomes one mark, then blanks go."""
    marked = F.regexp_replace(_col(text), WORD_RUN, "x")
    return F.length(F.regexp_replace(marked, SPACE_RUN, ""))


def chars_per_token(text: Column | str, tokens: Column | None = None) -> Column:
    """Characters per token; -1 for text without tokens."""
    text = _col(text)
    tokens = token_count(text) if tokens is None else tokens
    ratio = F.try_divide(F.length(text).cast("double"), tokens.cast("double"))
    return F.when(text.isNotNull(), F.coalesce(ratio, F.lit(-1.0)))
