"""Vector codes, token files and Merkle manifests against brute force, on small tables with awkward rows."""

import collections
import hashlib
import math
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from srcsieve.llm import merkle, queries, token_files, vector_codes, word_ids  # noqa: E402
from srcsieve.session import scratch_path  # noqa: E402

BPE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
CLASHES = (
    "id vector code error n part entry place total own _label label_error start n_tokens ids_crc32 file base "
    "_id _group _hash _pos _n _chunk _top _proof _root _range _rows _before _tie _step _node0 _also _name _digest"
).split()


def with_clashes(frame):
    """Columns named like those the operators make."""
    return frame.withColumns({name: F.lit("x") for name in CLASHES if name not in frame.columns})


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


# Words


def test_words_are_cut_as_the_tokenizer_cuts_them(tokenizer):
    rng = random.Random(7)
    parts = [*"ab 's\n\t.,1é  \r'tdlv“-Я中 ́\x00", "re", "ll", " \n", "  ", "word", "<|endoftext|>", "<|"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += [None, "", " ", "\n\n", "it's  a\n\n\ndog's ", "x" * 5000, "'s't 're", "😀 ok", "a<|endoftext|> b"]
    encoder = word_ids.WordIds(BPE, max_words=500)  # emptied many times
    got = [ids.tolist() for at in range(0, len(texts), 100) for ids in encoder.encode(pa.array(texts[at : at + 100], pa.string()))]
    assert got == [tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]


def test_blocks_do_not_change_ids(tokenizer, monkeypatch):
    texts = ["one two three"] * 5 + ["", "four\nfive", None, "é" * 50]
    whole = [ids.tolist() for ids in word_ids.WordIds(BPE).encode(pa.array(texts))]
    monkeypatch.setattr(word_ids, "BLOCK_BYTES", 20)
    assert [ids.tolist() for ids in word_ids.WordIds(BPE).encode(pa.array(texts).slice(0))] == whole
    assert [ids.tolist() for ids in word_ids.WordIds(BPE).encode(pa.array(texts).slice(3, 4))] == whole[3:7]
    assert word_ids.WordIds(BPE).encode(pa.array([], pa.string())) == []


# Vector codes


def coded_plainly(rows, parts, entries, rounds, scale=4096):
    """``(id, label, code, error)`` and codebooks by measuring every entry."""
    kept = [(i, l, v) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, l, [math.floor(scale * float(np.float32(x))) for x in v]) for i, l, v in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return [], []
    width = len(kept[0][2]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for _, _, v in kept[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, own)), e) for e, own in enumerate(book))

    for _ in range(rounds):
        groups = [collections.defaultdict(list) for _ in range(parts)]
        for _, _, v in kept:
            for p, part in enumerate(cut(v)):
                groups[p][near(part, books[p])[1]].append(part)
        books = [
            [[sum(c) // len(c) for c in zip(*groups[p][e])] if e in groups[p] else own for e, own in enumerate(books[p])]
            for p in range(parts)
        ]
    out = []
    for i, l, v in kept:
        found = [near(part, books[p]) for p, part in enumerate(cut(v))]
        out.append((i, l, bytes(e for _, e in found), sum(far for far, _ in found)))
    return out, books


VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(n, width, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.choice((-1.5, 0.25, rng.gauss(0, 1))) for _ in range(width)], rng.choice((None, 0, 1))) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [float("nan")] * width, 1), (n + 2, [None] + [0.0] * (width - 1), 0)]
    rows += [(n + 3, [float("inf")] + [0.0] * (width - 1), 0), (None, [0.1] * width, 2), (5, rows[4][1], 1), rows[6], rows[6]]
    return rows


@pytest.mark.parametrize("parts,entries,width", [(8, 16, 16), (2, 70, 6), (1, 3, 1)])
def test_vector_codes_are_those_of_a_full_search(spark, parts, entries, width):
    rows = vectors(120, width)
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    want, books = coded_plainly(rows, parts, entries, 3)
    coded, codebooks = vector_codes.compress(with_clashes(frame), parts=parts, entries=entries, rounds=3)
    assert codebooks.tolist() == books
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, bytes) else x for x in r)
    got = [(r["vec_id"], r["label"], bytes(r["code"]), r["error"]) for r in coded.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    sums = collections.Counter()
    for _, label, _, error in want:
        sums[label] += error
    for row in vector_codes.with_label_error(coded).collect():
        assert row["label_error"] == sums[row["label"]]


def test_slices_hold_every_nearest_entry_and_break_ties_low():
    rng = np.random.default_rng(1)
    entries = rng.integers(-5, 5, (130, 3))
    points = rng.integers(-8, 8, (2000, 3))
    far = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    own = vector_codes.Slices(entries)
    into, least = own.nearest(points)
    assert (into == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()
    masks = own.candidates(points)
    chosen = masks[np.arange(2000), into // 64] >> (into % 64).astype(np.uint64) & np.uint64(1)
    assert chosen.all()
    counted = sum(int(x).bit_count() for x in masks.reshape(-1))
    assert counted < far.size / 2  # the slices leave most entries out


def test_vector_codes_of_odd_tables(spark):
    for rows in ([], [(1, None, 1)]):
        coded, books = vector_codes.compress(spark.createDataFrame(rows, VECTORS))
        assert vector_codes.with_label_error(coded).collect() == [] and books.size == 0
    alike = spark.createDataFrame([(i, [0.5] * 8, None) for i in range(5)], VECTORS)
    coded, books = vector_codes.compress(alike)
    assert {(bytes(r["code"]), r["error"]) for r in coded.collect()} == {(bytes(8), 0)} and books.shape == (8, 5, 1)
    for bad in ([(1, [1.0] * 8, 0), (2, [1.0] * 16, 0)], [(1, [1.0] * 7, 0)], [(1, [1e30] * 8, 0)]):
        with pytest.raises(ValueError):
            vector_codes.compress(spark.createDataFrame(bad, VECTORS))


def test_reconstruction_is_as_far_as_the_error_says(spark):
    frame = spark.createDataFrame([r for r in vectors(60, 16) if r[0] is not None and r[0] < 60], VECTORS)
    coded, books = vector_codes.compress(frame)
    back = {r["vec_id"]: vector_codes.reconstruct(np.frombuffer(r["code"], np.uint8)[None], books)[0] for r in coded.collect()}
    error = {r["vec_id"]: r["error"] for r in coded.collect()}
    for row in frame.collect():
        whole = np.floor(np.float32(row["embedding"]).astype(float) * 4096) / 4096
        if collections.Counter(r["vec_id"] for r in frame.collect())[row["vec_id"]] == 1:
            assert round(((whole - back[row["vec_id"]]) ** 2).sum() * 4096**2) == error[row["vec_id"]]


# Token files

ODD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "a null id"), (5, "word"), (5, "word"), (5, "another"), (7, "two words"),
    (-4, "x" * 70_000), (9, "é ñ ß x  y\n\n z \x1f"), (10, "日本語 " * 300), (11, "<|endoftext|>"),
]


def files_plainly(tokenizer, rows):
    """``(id, start, n_tokens, crc32)`` in the order of the files."""
    digest = lambda text: hashlib.md5((text or "").encode()).hexdigest()
    out, at = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1]))):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)), ids))
        at += len(ids)
    return out


@pytest.mark.parametrize("part_bytes", [1 << 20, 200])
def test_token_files_read_back(spark, documents, tokenizer, part_bytes):
    folder = scratch_path(spark, "token-files")
    docs = with_clashes(documents(ODD)).repartition(3)
    manifest = token_files.write_token_files(docs, folder, BPE, part_bytes=part_bytes)
    want = files_plainly(tokenizer, ODD)
    read = token_files.read_documents(spark, folder, with_ids=True).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in read] == [w[:4] for w in want]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in read] == [w[4] for w in want]
    parts = manifest.orderBy("part").collect()
    assert [p["base"] for p in parts] == np.cumsum([0, *[p["n_ids"] for p in parts]])[:-1].tolist()
    assert all(p["width"] == 2 for p in parts) and (part_bytes > 1000 or len(parts) > 4)
    files = token_files.TokenFiles(spark, folder)
    assert [files[n].tolist() for n in range(len(files))] == [w[4] for w in want]
    with pytest.raises(IndexError):
        files[len(files)]


def test_token_files_of_an_empty_table(spark, documents):
    folder = scratch_path(spark, "token-files")
    assert token_files.write_token_files(documents([]), folder, BPE).collect() == []
    assert token_files.read_documents(spark, folder).collect() == []
    assert len(token_files.TokenFiles(spark, folder)) == 0


def test_files_of_a_lost_attempt_do_not_count(spark, documents, tokenizer):
    """A part written again under another name, as by a task that ran twice, changes nothing."""
    folder = scratch_path(spark, "token-files")
    token_files.write_token_files(documents(ODD), folder, BPE)
    for kind in ("bin", "idx", "ids"):
        open(f"{folder}/part-000000-999.{kind}", "wb").write(b"half of a file")
    read = token_files.read_documents(spark, folder).orderBy("start").collect()
    assert [tuple(r) for r in read] == [w[:4] for w in files_plainly(tokenizer, ODD)]


def test_offsets_do_not_overflow_32_bits(spark):
    """Bases are prefix sums of 64-bit counts."""
    folder = scratch_path(spark, "token-files")
    parts = spark.createDataFrame([(i, f"p{i}", 1, 1 << 31, 2) for i in range(4)], token_files.PART)
    parts.write.parquet(f"{folder}/parts")
    bases = token_files.write_manifest(spark, folder).orderBy("part").collect()
    assert [r["base"] for r in bases] == [i << 31 for i in range(4)]


def test_query_of_token_files(spark, tables, tokenizer):
    rows = tables("SELECT doc_id, text FROM '@documents.parquet'")
    got = queries.Q["op12_token_files"](spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(w[:4] for w in files_plainly(tokenizer, rows))


# Merkle manifests


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, fan_out):
    """``(root, proofs)`` of a list of digests; a proof is a list of ``(before, after)``."""
    proofs = [[] for _ in nodes]
    under = [[n] for n in range(len(nodes))]
    while len(nodes) > 1:
        above, held = [], []
        for at in range(0, len(nodes), fan_out):
            run = nodes[at : at + fan_out]
            for slot in range(len(run)):
                for leaf in under[at + slot]:
                    proofs[leaf].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            above.append(sha(*run))
            held.append([leaf for own in under[at : at + fan_out] for leaf in own])
        nodes, under = above, held
    return nodes[0], proofs


def audited(rows, fan_out=3):
    """Sorted rows of ``audit`` with newlines deleted in documents of an even crc32."""
    groups = collections.defaultdict(list)
    for row in rows:
        i, text, lang, source, n_chars = row
        leaf = lambda t: sha(*map(framed, (i, source, lang, n_chars, t)))  # noqa: B023, E731
        even = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        now = leaf(text.replace("\n", "") if even and text is not None else text)
        groups[source].append((i is not None, i or 0, leaf(text), now))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {source: climb([r[2] for r in sorted(groups[source])], fan_out) for source in order}
    root, tops = climb([trees[source][0] for source in order], fan_out) if order else (None, [])
    out = []
    for source, top in zip(order, tops):
        for (known, i, leaf, now), proof in zip(sorted(groups[source]), trees[source][1]):
            steps, folded = proof + top, now
            for before, after in steps:
                folded = sha(before, folded, after)
            siblings = sha(*[b + a for b, a in steps])
            out.append((i if known else None, leaf, trees[source][0], root, siblings, folded, folded == root))
    return sorted(out, key=repr)


def audit(frame, **options):
    suspect = F.crc32(frame["doc_id"].cast("string").cast("binary")) % 2 == 0
    found = merkle.audit(frame, suspect, F.replace(frame["text"], F.lit("\n"), F.lit("")), **options)
    return sorted((tuple(r) for r in found.collect()), key=repr)


FULL = "doc_id long, text string, lang string, source string, n_chars long"


def tree_rows(n, seed=5):
    rng = random.Random(seed)
    rows = [(i, f"line {i}\nnext é" * (i % 4), None if i % 7 == 0 else "en", rng.choice((None, "", "a", "b", "hot", "hot", "hot", f"s{i % 40}")), i)
            for i in range(n)]
    return rows + [(None, "a null id", "en", "hot", None), (3, None, None, "é", 0), (9, "x\n" * 40_000, "en", "a", 1), rows[5], rows[5]]


@pytest.mark.parametrize("fan_out,levels", [(3, 5), (3, 1), (2, 2), (4, 1)])
def test_manifest_is_that_of_plain_trees(spark, fan_out, levels):
    rows = tree_rows(160)
    frame = with_clashes(spark.createDataFrame(rows, FULL).repartition(6))
    assert audit(frame, fan_out=fan_out, levels=levels) == audited(rows, fan_out)


@pytest.mark.parametrize("sizes", [[], [1], range(1, 11)])
def test_small_trees(spark, sizes):
    rows = [(i, f"a\nb{i}", "en", f"s{size}", i) for size in sizes for i in range(size)]
    assert audit(spark.createDataFrame(rows, FULL)) == audited(rows)


def test_tampering_is_seen_where_a_newline_goes(spark):
    rows = [(i, f"a\nb{i}" if i % 2 else f"ab{i}", "en", "s", i) for i in range(40)]
    for i, *_, verified in audit(spark.createDataFrame(rows, FULL)):
        assert verified == (not (i % 2 and zlib.crc32(str(i).encode()) % 2 == 0))


def test_proofs_fold_to_the_root_and_no_other_leaf_does(spark):
    found = merkle.merkle_manifest(spark.createDataFrame(tree_rows(60), FULL))
    folded = found.select(
        merkle.fold(F.col("leaf"), F.col("proof")).alias("own"),
        merkle.fold(F.sha2(F.col("leaf"), 256), F.col("proof")).alias("other"), "root",
    )
    assert all(r["own"] == r["root"] != r["other"] for r in folded.collect())


def test_the_table_of_words_stays_small(tokenizer):
    encoder = word_ids.WordIds(BPE, max_words=100)
    rare = [f" rare{i}x" for i in range(1000)]
    for at in range(0, len(rare), 20):  # one call with over twice the table, then words that come again
        texts = ["".join(rare) if at == 0 else "again" + "".join(rare[at : at + 20]) + "y" * 500]
        got = [ids.tolist() for ids in encoder.encode(pa.array(texts))]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.words) + len(encoder.earlier) <= 100
        assert all(len(word) <= word_ids.MAX_WORD_BYTES for word in [*encoder.words, *encoder.earlier])
    assert b"again" in encoder.words or b"again" in encoder.earlier
