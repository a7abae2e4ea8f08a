"""What the operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

#: White space between words, the same set everywhere.
SPACE = r"[\x20\x09-\x0D]"
_SPACE = re.compile(SPACE.encode())
#: A-Z to a-z on UTF-8 bytes; other letters stay as they are.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
UPPER_LETTERS, LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, text)`` alone, null texts empty; no other column of ``docs`` can clash."""
    return docs.select(docs[id_col].alias(id_col), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """``data`` cut before white space into blocks of about ``size`` bytes.

    Memory for the words of a very long text then follows the block, not the text.
    """
    at = 0
    while len(data) - at > size:
        cut = _SPACE.search(data, at + size)
        if cut is None:
            break
        yield data[at : cut.start()]
        at = cut.start()
    yield data[at:]


def in_fold(id_column: Column, folds: int = 5) -> Column:
    """True for ids of the held-out fold: crc32 of the id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds == 0, F.lit(False))
