"""Checked-out source trees."""

from __future__ import annotations

import time
from codecs import getincrementaldecoder
from collections.abc import Iterator
from urllib.parse import urlparse

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from srcsieve.operators.batches import slices

SNIFF_BYTES = 2048


def _open_root(root: str) -> tuple[FileSystem, str]:
    """File system and plain path of a folder given as a path or URI."""
    if root.startswith("file:"):
        root = urlparse(root).path
    if "://" in root:
        return FileSystem.from_uri(root)
    return LocalFileSystem(), root.rstrip("/")


def _walker(root: str, levels: int | None):
    """Replace folders (``length`` null) by what lies below them; files stay.

    Folders ``levels`` below a given one are returned unopened; with None every folder is opened.
    """

    def listing(repo: str, names: list[str], sizes: list[int | None]) -> pd.DataFrame:
        return pd.DataFrame({"repo_name": repo, "file_name": names, "length": pd.array(sizes, dtype="Int64")})

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = _open_root(root)
        for batch in batches:
            known = batch["length"].notna()
            if known.any():
                yield batch[known].astype({"length": "int64"})
            for repo, inner in zip(batch["repo_name"][~known], batch["file_name"][~known]):
                top = f"{base}/{repo.replace('/', '__')}"
                pending = [(f"{top}/{inner}" if inner else top, 0)]
                while pending:
                    folder, depth = pending.pop()
                    entries = files.get_file_info(FileSelector(folder, allow_not_found=True))
                    below = [e.path for e in entries if e.type == FileType.Directory]
                    found = [e for e in entries if e.is_file]
                    if found:
                        yield listing(repo, [e.path[len(top) + 1 :] for e in found], [e.size for e in found])
                    if depth + 1 == levels:
                        if below:
                            yield listing(repo, [path[len(top) + 1 :] for path in below], [None] * len(below))
                    else:
                        pending += [(path, depth + 1) for path in below]

    return walk


def list_source_files(repos: DataFrame, root: str, levels: int = 2) -> DataFrame:
    """Regular files of each repository as ``(repo_name, file_name, length)``.

    ``repos`` holds distinct ``repo_name`` values; a repository lies in ``root`` under its
    name with ``/`` written as ``__``. The built-in file sources leave out names that start
    with ``_`` or ``.``, such as ``__init__.py``, so folders are walked inside the tasks. The
    folders found ``levels`` down are dealt out anew, so that one vast repository is walked
    by many tasks.
    """
    schema = "repo_name string, file_name string, length long"
    tasks = repos.sparkSession.sparkContext.defaultParallelism * 4
    tops = repos.select("repo_name", F.lit("").alias("file_name"), F.lit(None).cast("long").alias("length"))
    upper = tops.repartition(tasks, "repo_name").mapInPandas(_walker(root, levels), schema)
    return upper.repartition(tasks, "repo_name", "file_name").mapInPandas(_walker(root, None), schema)


def _read_bytes(opened: FileSystem, path: str, tries: int = 3) -> tuple[bytes | None, str | None]:
    """The bytes of a file, or why it cannot be read. A store that fails for a moment is asked again."""
    for attempt in range(1, tries + 1):
        try:
            with opened.open_input_stream(path, compression=None) as stream:
                return stream.read(), None
        except OSError as error:
            lasting = isinstance(error, (FileNotFoundError, PermissionError, IsADirectoryError))
            if lasting or attempt == tries:
                return None, f"{type(error).__name__}: {error}"
            time.sleep(0.2 * 2**attempt)
    raise ValueError("tries must be at least 1")


def read_file_contents(
    files: DataFrame, root: str, batch_bytes: int = 32 << 20, error: str | None = None
) -> DataFrame:
    """Add the ``content`` bytes of listed files; unreadable files are skipped.

    With ``error`` they stay, their content null and the reason in the column of that name.
    Filter the listing first, so only wanted files are opened. Files are spread by path,
    so a repository with most of the files is read by all tasks.
    """
    added = [T.StructField("content", T.BinaryType())] + ([T.StructField(error, T.StringType())] if error else [])
    schema = T.StructType(files.schema.fields + added)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, base = _open_root(root)

        def joined(batch: pa.RecordBatch, places: list[int], contents: list, reasons: list) -> pa.RecordBatch:
            part = batch.take(pa.array(places, pa.int32()))
            new = [pa.array(contents, pa.binary())] + ([pa.array(reasons, pa.string())] if error else [])
            return pa.RecordBatch.from_arrays([*part.columns, *new], schema.fieldNames())

        for batch in batches:
            places, contents, reasons, held = [], [], [], 0
            repos, names = batch.column("repo_name").to_pylist(), batch.column("file_name").to_pylist()
            for place, (repo, name) in enumerate(zip(repos, names)):
                path = f"{base}/{repo.replace('/', '__')}/{name}"
                content, reason = _read_bytes(opened, path)
                if reason and not error:
                    continue
                places.append(place)
                contents.append(content)
                reasons.append(reason)
                held += len(content or b"")
                if held >= batch_bytes:
                    yield joined(batch, places, contents, reasons)
                    places, contents, reasons, held = [], [], [], 0
            if places:
                yield joined(batch, places, contents, reasons)

    tasks = files.sparkSession.sparkContext.defaultParallelism * 4
    return files.repartition(tasks, "repo_name", "file_name").mapInArrow(read, schema)


def read_source_tree(repos: DataFrame, root: str) -> DataFrame:
    """Every file of every repository with its bytes."""
    return read_file_contents(list_source_files(repos, root), root)


_JAPANESE = "のにはをたがでてとしれさいるもなかスンルトーリア。、"
#: Encodings tried on bytes that come in runs above 127, each with common characters of its texts.
ENCODINGS = {
    "shift_jis": _JAPANESE,
    "euc_jp": _JAPANESE,
    "gb18030": "的一是不了在有人我他这为之大来以个中上们用到说和地要，。",
    "big5": "的一是不了在有人我他這為之大來以個中上們用到說和地要，。",
    "euc_kr": "이다는을의에고하가지로한기사도를리어자은인서스",
    "cp1251": "оеаинтсрвлкмдпу",
    "koi8-r": "оеаинтсрвлкмдпу",
    "cp866": "оеаинтсрвлкмдпу",
}
#: Least share of those characters among all beyond ASCII; far more by chance where one byte is a character.
MIN_COMMON, MIN_COMMON_SINGLE = 0.1, 0.5
SINGLE_BYTE = ("cp1251", "koi8-r", "cp866")


def _unmarked_utf16(head: bytes) -> str | None:
    """UTF-16 without a mark, if every other byte is mostly zero and few of the others are."""
    pairs = len(head) // 2
    if pairs < 2:
        return None
    first, second = head[0 : 2 * pairs : 2].count(0) / pairs, head[1 : 2 * pairs : 2].count(0) / pairs
    if max(first, second) < 0.5 or min(first, second) > 0.1:
        return None
    return "utf-16-be" if first > second else "utf-16-le"


def _guess_encoding(head: bytes) -> str:
    """The encoding of bytes that are not UTF-8.

    Letters beyond ASCII stand alone in western texts and in runs in others. A text of the second kind
    has the encoding under which most of its characters are common ones.
    """
    high = [byte >= 0x80 for byte in head]
    in_runs = sum(a and (b or c) for a, b, c in zip(high, [False, *high], [*high[1:], False]))
    if 2 * in_runs >= sum(high):
        shares = {}
        for encoding, common in ENCODINGS.items():
            try:
                text = getincrementaldecoder(encoding)().decode(head)  # a character cut by the end is no error
            except UnicodeDecodeError:
                continue
            others = [char for char in text if char > "\x7f"]
            shares[encoding] = sum(char in common for char in others) / max(len(others), 1)
        single = {encoding: shares.pop(encoding) for encoding in SINGLE_BYTE if encoding in shares}
        for group, least in ((shares, MIN_COMMON), (single, MIN_COMMON_SINGLE)):
            best = max(group, key=group.get, default=None)
            if best and group[best] >= least:
                return best
    return "cp1252" if any(0x80 <= byte < 0xA0 for byte in head) else "latin-1"


def _decode(raw: bytes, head_only_ascii: bool) -> str:
    """Text of bytes that are not plain UTF-8; undecodable bytes are dropped."""
    marks = (
        (b"\xff\xfe\x00\x00", "utf-32"), (b"\x00\x00\xfe\xff", "utf-32"),
        (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"), (b"\xef\xbb\xbf", "utf-8-sig"),
    )
    for mark, encoding in marks:
        if raw.startswith(mark):
            return raw.decode(encoding, errors="ignore")
    head = raw[:SNIFF_BYTES]
    unmarked = _unmarked_utf16(head)
    if unmarked:
        return raw.decode(unmarked, errors="ignore")
    if head_only_ascii and head.isascii():
        return raw.decode("ascii", errors="ignore")
    try:
        head.decode("utf-8")
        return raw.decode("utf-8", errors="ignore")
    except UnicodeDecodeError as error:
        if error.start >= len(head) - 3 and len(raw) > len(head):  # a character cut by the head's end
            return raw.decode("utf-8", errors="ignore")
    return raw.decode(_guess_encoding(head), errors="ignore")


def _decoder(head_only_ascii: bool):
    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for contents in slices(batch):
                texts = [None if raw is None else _decode(raw, head_only_ascii) for raw in contents]
                yield pa.array(texts, type=pa.string())

    return decode


def decode_text(df: DataFrame, content: str = "content", text: str = "text", ascii_head: str = "keep") -> DataFrame:
    """Replace ``content`` bytes by ``text``.

    Valid UTF-8 without a byte-order mark or a zero byte is cast in the JVM; only other files
    reach Python. The encoding is guessed from the first 2,048 bytes and defaults to UTF-8.
    ``ascii_head="drop"`` treats a file whose first 2,048 bytes are ASCII as ASCII
    throughout, which loses later letters; ``"keep"`` reads it as UTF-8.
    """
    raw = F.col(content)
    plain: Column = F.is_valid_utf8(raw.cast("string")) & ~F.startswith(raw, F.lit(b"\xef\xbb\xbf"))
    plain = plain & ~F.contains(raw, F.lit(b"\x00"))  # perhaps UTF-16 without a mark
    if ascii_head == "drop":
        head = F.substring(raw, 1, SNIFF_BYTES)
        plain = plain & ((F.length(head.cast("string")) < F.octet_length(head)) | (F.length(raw.cast("string")) == F.octet_length(raw)))
    guessed = _decoder(ascii_head == "drop")
    # The UDF sees null for plain rows, so their bytes never leave the JVM.
    others = guessed(F.when(~plain, raw))
    return (
        df.withColumn(text, F.when(plain, raw.cast("string")))
        .withColumn("_guessed", others)
        .withColumn(text, F.coalesce(F.col(text), F.col("_guessed")))
        .drop(content, "_guessed")
    )
