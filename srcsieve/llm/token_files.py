"""Flat files of token ids with 64-bit document offsets, for readers that map them into memory.

A part has three files: ``.bin`` holds the ids of its documents one after the other as unsigned integers,
``.idx`` where each document starts and the last ends as 64-bit integers, ``.ids`` the document ids as an
Arrow file. Documents ascend over all parts. A part counts from 0; its base, the ids of all parts before
it, is a prefix sum over the counts of the parts, kept in the ``manifest`` table of the folder.
Tasks write under names of their own, and the manifest, committed by Spark, says which files count,
so a lost or repeated task leaves no trace in the result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from srcsieve.llm.common import texts
from srcsieve.llm.word_ids import encoder

END_OF_DOCUMENT = 0
#: Text bytes of a part, about.
PART_BYTES = 32 << 20
#: Ids that a reader takes from a document at a time.
READ_IDS = 1 << 22
PART = "part int, file string, n_docs long, n_ids long, width int"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder named as Spark names it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def id_width(vocabulary: int) -> int:
    """Bytes of an id: two where all ids fit, else four."""
    return 2 if vocabulary <= 1 << 16 else 4


def _sorted_by_id(docs: DataFrame, id_col: str, part_bytes: int) -> DataFrame:
    """``docs`` in ranges of ascending ids, sorted within each.

    Equal ids are ordered by a digest of their text; copies with one id are exchangeable, so a running number
    may deal them out over ranges.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // part_bytes))
    keyed = docs.withColumns({"_digest": F.md5(F.col("text").cast("binary")), "_tie": F.monotonically_increasing_id()})
    order = [F.col(id_col).asc_nulls_first(), F.col("_digest"), F.col("_tie")]
    return keyed.repartitionByRange(int(n), *order).sortWithinPartitions(*order).select(id_col, "text")


def _part_writer(tokenizer_path: str, folder: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        name = f"part-{part:06d}-{context.taskAttemptId()}"
        store, root = opened(folder)
        encode, end = encoder(tokenizer_path).encode, np.array([END_OF_DOCUMENT], "<u4")
        docs = ids = 0
        with ExitStack() as files:
            out = {}
            for batch in batches:
                if not out:
                    out = {kind: files.enter_context(store.open_output_stream(f"{root}/{name}.{kind}")) for kind in ("bin", "idx")}
                    names = files.enter_context(store.open_output_stream(f"{root}/{name}.ids"))
                    schema = pa.schema([pa.field("id", batch.schema.field(0).type)])
                    names = files.enter_context(pa.ipc.new_file(names, schema))
                    out["idx"].write(np.zeros(1, "<i8").tobytes())
                found = encode(batch.column(1))
                flat = np.concatenate([part for own in found for part in (own, end)])
                out["bin"].write(flat.astype(f"<u{width}").tobytes())
                ends = ids + np.cumsum([len(own) + 1 for own in found])
                out["idx"].write(ends.astype("<i8").tobytes())
                names.write_batch(pa.record_batch([batch.column(0)], schema=schema))
                docs, ids = docs + len(found), int(ends[-1])
        if docs:
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "file": name, "n_docs": docs, "n_ids": ids, "width": width}],
                schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32())]),
            )

    return run


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Write every text of ``docs`` to ``folder``, which all executors share, and return the manifest.

    The manifest has ``part, file, n_docs, n_ids, width`` and, from prefix sums over the parts, ``first_doc``
    and ``base``: the documents and ids of all parts before. Each document ends with id 0.

    A null or empty text is its end alone. Null ids come first; rows with one id are ordered by their text's
    digest and all kept. Other columns are not read. An empty table gives an empty manifest and no files.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    store, root = opened(folder)
    store.create_dir(root, recursive=True)
    width = id_width(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True))
    ordered = _sorted_by_id(texts(docs, id_col, text_col), id_col, part_bytes)
    parts = ordered.mapInArrow(_part_writer(tokenizer_path, folder, width), PART)
    parts.write.mode("overwrite").parquet(os.path.join(folder, "parts"))
    return write_manifest(spark, folder)


def write_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Add up the parts of ``folder``. They have a row each, so one window over all of them stays small."""
    parts = spark.read.schema(PART).parquet(os.path.join(folder, "parts"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"first_doc": F.sum("n_docs").over(before), "base": F.sum("n_ids").over(before)}
    bases = parts.withColumns({name: F.coalesce(total, F.lit(0)) for name, total in sums.items()})
    bases.write.mode("overwrite").parquet(os.path.join(folder, "manifest"))
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{PART}, first_doc long, base long").parquet(os.path.join(folder, "manifest"))


class PartReader:
    """A part's files, mapped into memory where the store is a file system of the machine."""

    def __init__(self, folder: str, file: str, width: int) -> None:
        store, root = opened(folder)
        local = isinstance(store, fs.LocalFileSystem)
        read = pa.memory_map if local else store.open_input_file
        self._files = {kind: read(f"{root}/{file}.{kind}") for kind in ("bin", "idx", "ids")}
        self.width = width
        self.n_docs = self._files["idx"].size() // 8 - 1

    def __enter__(self) -> PartReader:
        return self

    def __exit__(self, *_) -> None:
        for file in self._files.values():
            file.close()

    def _numbers(self, kind: str, start: int, stop: int, dtype: str) -> np.ndarray:
        width, file = np.dtype(dtype).itemsize, self._files[kind]
        file.seek(start * width)
        return np.frombuffer(file.read_buffer((stop - start) * width), dtype)  # no copy of a mapped file

    def offsets(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Where documents ``start`` to ``stop`` begin, and where the last of them ends."""
        return self._numbers("idx", start, (self.n_docs if stop is None else stop) + 1, "<i8")

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from place ``start`` to ``stop`` of the part."""
        return self._numbers("bin", start, stop, f"<u{self.width}")

    def document(self, number: int) -> np.ndarray:
        """The ids of one document, with its end."""
        start, stop = self.offsets(number, number + 1).tolist()
        return self.ids(start, stop)

    def names(self) -> Iterator[pa.Array]:
        """The document ids, a batch at a time."""
        reader = pa.ipc.open_file(self._files["ids"])
        for at in range(reader.num_record_batches):
            yield reader.get_batch(at).column(0)


def _crc32(part: PartReader, start: int, stop: int) -> int:
    found = 0
    for at in range(start, stop, READ_IDS):
        found = zlib.crc32(part.ids(at, min(at + READ_IDS, stop)).astype("<u4").tobytes(), found)
    return found


def _document_reader(folder: str, id_type: pa.DataType, id_col: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            with PartReader(folder, row["file"], row["width"]) as part:
                done = 0
                for names in part.names():
                    places = part.offsets(done, done + len(names))
                    done += len(names)
                    bounds = list(zip(places[:-1].tolist(), places[1:].tolist()))
                    columns = {
                        id_col: names.cast(id_type),
                        "start": pa.array(row["base"] + places[:-1]),
                        "n_tokens": pa.array(np.diff(places)),
                        "ids_crc32": pa.array([_crc32(part, a, b) for a, b in bounds], pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array([part.ids(a, b).astype("<u4").tobytes() for a, b in bounds], pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)

    return run


def read_documents(
    spark: SparkSession, folder: str, id_col: str = "doc_id", id_type: str | T.DataType = "long", with_ids: bool = False
) -> DataFrame:
    """``(id_col, start, n_tokens, ids_crc32)`` of every document in the files, and its ids if asked for.

    ``start`` counts the ids of all documents before it, ``n_tokens`` the document's with its end; the
    checksum and the ids are over little-endian unsigned 32-bit integers.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = T._parse_datatype_string(id_type) if isinstance(id_type, str) else id_type
    schema = T.StructType([T.StructField(id_col, kind), *T.StructType.fromDDL("start long, n_tokens long, ids_crc32 long")])
    if with_ids:
        schema.add("ids", "binary")
    manifest = read_manifest(spark, folder).select("part", "file", "width", "base")
    parts = int(manifest.count())
    # A part has one row here and is a task's work, so rows are dealt out one by one.
    dealt = manifest.repartitionByRange(max(parts, 1), "part")
    return dealt.mapInArrow(_document_reader(folder, to_arrow_type(kind), id_col, with_ids), schema)


class TokenFiles:
    """Random access to the documents of a folder by their number in id order."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.folder = folder
        self.parts = read_manifest(spark, folder).orderBy("part").collect()
        self.first = np.array([row["first_doc"] for row in self.parts], dtype=np.int64)

    def __len__(self) -> int:
        return self.parts[-1]["first_doc"] + self.parts[-1]["n_docs"] if self.parts else 0

    def __getitem__(self, number: int) -> np.ndarray:
        if not 0 <= number < len(self):
            raise IndexError(number)
        row = self.parts[int(np.searchsorted(self.first, number, "right")) - 1]
        with PartReader(self.folder, row["file"], row["width"]) as part:
            return part.document(number - row["first_doc"]).copy()
