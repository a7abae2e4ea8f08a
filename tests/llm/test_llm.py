"""The training-data operators against brute force, on small tables with awkward rows."""

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from srcsieve.llm import (  # noqa: E402
    decontaminate, induced_sort, licenses, line_dedup, packing, quality_model, quality_rules, secret_scan,
    simhash, suffix_dedup, text_stats, token_count,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "a null id"), (5, "word"), (5, "word"), (7, "two words"),
    (8, "x" * 70_000), (9, "é ñ ß x  y\n\n z \x1f"), (10, "K under the mit license K"),
]


def by_id(frame, key="doc_id"):
    found = collections.defaultdict(list)
    for row in frame.collect():
        found[row[key]].append(row)
    return found


@pytest.fixture(scope="module")
def sample(tables):
    return tables("SELECT doc_id, text FROM '@documents.parquet' ORDER BY doc_id")


def with_clashes(frame):
    """Columns named like those the operators make."""
    names = ("fingerprint", "component_id", "at", "n", "own", "key", "spans", "words", "piece", "bin", "score", "row")
    return frame.withColumns({name: F.lit("x") for name in names})


OPERATORS = {
    "simhash": lambda docs, spark: simhash.near_duplicates(docs),
    "tokens": lambda docs, spark: token_count.count_tokens(docs, PIECES),
    "suffixes": lambda docs, spark: suffix_dedup.remove_repeats(docs),
    "model": lambda docs, spark: quality_model.score_quality(docs, labels(spark)),
    "lines": lambda docs, spark: line_dedup.dedup_lines(docs),
    "secrets": lambda docs, spark: secret_scan.scan_secrets(docs, fresh(spark)),
    "rules": lambda docs, spark: quality_rules.quality_verdicts(docs, labels(spark)),
    "licenses": lambda docs, spark: licenses.license_labels(docs),
    "packing": lambda docs, spark: packing.pack_documents(docs, BPE, capacity=64),
}


def labels(spark, rows=((5, 1), (7, None), (8, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int")


def fresh(spark):
    from srcsieve.session import scratch_path

    return scratch_path(spark, "ledger")


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_each_come_back(spark, documents, name):
    found = by_id(OPERATORS[name](with_clashes(documents(ODD)), spark))
    want = collections.Counter(i for i, _ in ODD)
    assert set(found) == set(want)
    if name != "packing":
        assert {i: len(rows) for i, rows in found.items()} == want


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, documents, name):
    assert OPERATORS[name](documents([]), spark).count() == 0


def fingerprint_by_hand(text):
    from xxhash import xxh64_intdigest

    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(prints, distance=2):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sorted(prints):
        for b in sorted(prints):
            if a < b and (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in prints}


def test_simhash_matches_brute_force(spark, documents, sample):
    rows = sample + [(1000 + i, t) for i, (_, t) in enumerate(sample[:20])] + [(2000, ""), (2001, None), (2002, "A b")]
    prints = {i: fingerprint_by_hand(t or "") for i, t in rows}
    found = {r["doc_id"]: r for r in simhash.near_duplicates(documents(rows)).collect()}
    assert {i: r["fingerprint"] % (1 << 64) for i, r in found.items()} == prints
    assert {i: r["component_id"] for i, r in found.items()} == components_by_hand(prints)


def test_simhash_of_long_text_is_that_of_its_words():
    words = [f"w{i % 5000}" for i in range(300_000)]
    text = " ".join(words)
    assert len(text) > 1 << 20
    whole = simhash.fingerprint(text)
    blocks = list(simhash.word_blocks(text.encode()))
    assert len(blocks) > 1 and b"".join(blocks).split() == text.encode().split()
    assert whole == simhash.fingerprint(text.replace(" ", "\n"))


def test_crowded_keys_lose_no_pair(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(300)} | {rng.getrandbits(64) for _ in range(50)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2}
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    for limit in (1024, 16):
        got = {tuple(r) for r in simhash.close_pairs(frame, max_members=limit).collect()}
        assert got == want


def test_near_duplicates_keep_one(spark, documents):
    text = " ".join(f"word{i}" for i in range(400))
    kept = simhash.drop_near_duplicates(documents([(3, text), (1, text + " end"), (2, "other things"), (None, text)]))
    assert {r["doc_id"] for r in kept.collect()} >= {1, 2, None}
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


STAGES = {
    "rules": lambda docs, spark: quality_rules.drop_low_quality(docs, labels(spark)),
    "lines": lambda docs, spark: line_dedup.drop_repeated_lines(docs),
    "simhash": lambda docs, spark: simhash.drop_near_duplicates(docs),
    "benchmark": lambda docs, spark: decontaminate.drop_contaminated(
        docs, spark.createDataFrame([(1, "an item of words that no text here holds"), (2, None)], "item_id long, text string")
    ),
}
INTERNAL = (
    "_counts", "_of_words", "_of_lines", "_row", "_key", "_lines", "_with_word", "_gone", "_kept", "_n_lines", "_n_removed",
    "_starts", "_own", "_of", "_item", "_n", "_digest", "item_id", "fingerprint", "component_id", "quality", "starts", "own",
)


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns_of_any_name(name, spark, documents):
    lines = "\n".join(f"line {i} of a passage that is long enough to stay on its own" for i in range(4))
    rows = [*ODD, (20, lines), (21, "begin\n" + lines + "\nend"), (21, "begin\n" + lines + "\nend")]
    docs = documents(rows)
    plain = STAGES[name](docs, spark)
    clashing = STAGES[name](docs.withColumns({c: F.lit("x") for c in INTERNAL}), spark)
    assert plain.columns == docs.columns and clashing.columns == [*docs.columns, *INTERNAL]
    by_text = lambda frame: sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=repr)
    assert by_text(plain) == by_text(clashing)
    assert {r[c] for r in clashing.collect() for c in INTERNAL} <= {"x"}
    empty = STAGES[name](docs.limit(0), spark)
    assert empty.count() == 0 and empty.columns == docs.columns


def test_token_counts_match_the_tokenizer():
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = token_count.vocabulary(PIECES)
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    counter = token_count.TokenCounter(pieces)
    rng = random.Random(1)
    alphabet = "abcde  \n▁é漢😀<unk>s0x41K"
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
        text += rng.choice(["", "<unk>", "<s>", "é<unk>", "hello world", "a" * 70])
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text


def test_token_ties_go_to_the_longer_piece():
    from tokenizers import Tokenizer, models, pre_tokenizers

    rng = random.Random(2)
    for _ in range(50):
        words = {"".join(rng.choice("ab▁") for _ in range(rng.randrange(1, 4))) for _ in range(8)}
        pieces = [("<unk>", 0.0)] + [(w, float(-rng.randrange(3))) for w in sorted(words)]
        tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
        tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
        counter = token_count.TokenCounter(pieces)
        known = {c for w, _ in pieces[1:] for c in w if len(w) == 1}
        for _ in range(40):
            text = "".join(rng.choice(sorted(known) or ["a"]) for _ in range(rng.randrange(1, 12)))
            if known >= set(text) | {"▁"}:
                assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), (pieces, text)


@pytest.mark.parametrize("memory,queue,chunk", [(1, 5, 7), (4, 50, 64), (1 << 20, 1 << 20, 1 << 20)])
def test_suffix_order_in_and_out_of_memory(monkeypatch, memory, queue, chunk):
    monkeypatch.setattr(induced_sort, "CHUNK", chunk)
    rng = np.random.default_rng(memory)
    for _ in range(150):
        body = rng.integers(2, 2 + rng.integers(1, 4), rng.integers(0, 90), dtype=np.uint8)
        text, depth = np.append(body, 0).astype(np.uint8), int(rng.integers(1, 30))
        with induced_sort.Scratch(memory, queue) as scratch:
            got = [(int(p), int(n)) for a, b in induced_sort.sorted_suffixes(text, depth, scratch) for p, n in zip(a, b)]
        data = bytes(text)
        assert sorted(p for p, _ in got) == list(range(len(body)))
        for (p, _), (q, shared) in zip(got, got[1:]):
            assert data[p : p + depth] >= data[q : q + depth]
            same = 0
            while same < depth and max(p, q) + same < len(data) and data[p + same] == data[q + same]:
                same += 1
            assert shared == same


def repeats_by_hand(rows, length):
    whole = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[k : k + length] for _, b in whole for k in range(len(b) - length + 1))
    found = []
    for i, b in whole:
        runs = []
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                if runs and k <= runs[-1][1]:
                    runs[-1][1] = k + length
                else:
                    runs.append([k, k + length])
        edges = [0, *(e for run in runs for e in run), len(b)]
        kept = b"".join(b[x:y] for x, y in zip(edges[::2], edges[1::2]))
        found.append((i, len(b), len(b) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
    return found


@pytest.mark.parametrize("length,gram,crowded", [(200, 24, 4096), (12, 4, 4096), (12, 4, 1), (40, 9, 2)])
def test_suffix_dedup_matches_brute_force(spark, documents, sample, monkeypatch, length, gram, crowded):
    monkeypatch.setattr(suffix_dedup, "MAX_SEGMENTS", crowded)
    rng = random.Random(length)
    passage = "".join(rng.choice("abcdé ") for _ in range(90))
    rows = [(i, t[:1500]) for i, t in sample[:40]]
    rows += [(500 + i, f"{i}x{rng.random()}" + passage + f"{rng.random()}" + passage[i:]) for i in range(12)]
    rows += [(700, "ab" * 200), (701, "c" * 500), (702, None), (703, "short"), (704, "short"), (704, passage), (704, passage)]
    rows += [(800, "é" * 120), (801, rows[0][1] + "y" + rows[1][1])]
    got = suffix_dedup.remove_repeats(documents(rows), length=length, gram=gram).collect()
    clean = lambda r: (r[0], r[1], r[2], r[3], r[4], bytes(r[5]))
    assert sorted(map(clean, got), key=repr) == sorted(repeats_by_hand(rows, length), key=repr)


def test_suffix_dedup_of_a_text_longer_than_a_buffer(spark, documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUFFER", 1 << 12)
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh") for _ in range(30_000))
    rows = [(1, text), (2, "q" + text[10_000:14_000] + "z"), (3, text[:150])]
    got = suffix_dedup.remove_repeats(documents(rows)).drop("kept").collect()
    assert sorted(map(tuple, got)) == sorted(r[:-1] for r in repeats_by_hand(rows, 200))


def test_segments_that_all_have_copies_are_not_sorted(spark, documents, monkeypatch):
    def none(length):
        def run(batches):
            for batch in batches:
                raise AssertionError(f"{batch.num_rows} segments are sorted")
            yield from ()

        return run

    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    copied = [letters(900), letters(200), letters(3000)]
    rows = [(i, t) for i, t in enumerate(copied * 3)] + [(20, letters(800)), (21, "short"), (22, None)]
    got = {}
    for name, sorter, more in (("settled", none, []), ("both", suffix_dedup._sorter, [(30, letters(50) + copied[0][100:700] + letters(90))])):
        monkeypatch.setattr(suffix_dedup, "_sorter", sorter)
        monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 500)
        found = suffix_dedup.remove_repeats(documents(rows + more)).drop("kept").collect()
        assert sorted(map(tuple, found)) == sorted(r[:-1] for r in repeats_by_hand(rows + more, 200)), name


def counts_by_hand(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
        len(covered), len(lines), len(set(words)),
    )


def test_quality_counts(spark, documents, sample):
    rows = sample + [(900, None), (901, "a b c d e a b c d e f"), (902, "x " * 40), (903, "a\n a\na\n\n\n"), (904, "# *\x0b$é")]
    got = quality_rules.quality_counts(documents(rows))
    want = {i: counts_by_hand(t) for i, t in rows}
    assert {r["doc_id"]: tuple(r[c] for c in text_stats.COUNTS[:7]) for r in got.collect()} == want


def test_rules_reject_what_labels_mark(spark, documents):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    rows, marks = [], []
    for i in range(600):
        bad = i % 3 == 0
        rows.append((i, " ".join(word() + ("###" if bad else "") for _ in range(30))))
        marks.append((i, 0 if bad else 1))
    verdicts = quality_rules.quality_verdicts(documents(rows), labels(spark, marks))
    kept = {r["doc_id"]: r["kept"] for r in verdicts.collect()}
    assert all(kept[i] == bool(q) for i, q in marks)
    plan = verdicts._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    left = quality_rules.drop_low_quality(documents(rows), labels(spark, marks))
    assert {r["doc_id"] for r in left.collect()} == {i for i, q in marks if q}


def test_model_on_held_out_rows(spark, documents, tables):
    rows = tables("SELECT doc_id, text FROM '@../sf0.01/documents.parquet'")
    marks = tables("SELECT doc_id, quality FROM '@../sf0.01/labels.parquet'")
    scored = quality_model.score_quality(documents(rows), labels(spark, marks))
    truth = dict(marks)
    held = [(r["predicted"], truth[r["doc_id"]], r) for r in scored.collect() if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for *_, r in held)
    assert sum(p == t for p, t, _ in held) >= 0.93 * len(held)


def test_model_without_labels_scores_one_half(spark, documents):
    scored = quality_model.score_quality(documents([(1, "a b"), (2, None)]), labels(spark, []))
    assert [r["score"] for r in scored.collect()] == [0.5, 0.5]


def test_lines(spark, documents):
    shared = "one line\n\ntwo line\nthree line\nfour line"
    rows = [(1, shared), (2, "x\n" + shared + "\ny"), (3, None), (4, "a\na\na\na"), (5, "one line\ntwo line\nother")]
    got = {r["doc_id"]: (r["text"], r["_n_removed"]) for r in line_dedup.dedup_lines(documents(rows)).collect()}
    assert got[1] == (shared, 0) and got[3] == (None, 0) and got[5][1] == 0
    assert got[2] == ("x\n\ny", 4)
    assert got[4] == ("a", 3)
    left = line_dedup.drop_repeated_lines(documents([(1, shared), (2, shared), (3, "")]))
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3]


def test_ledger_scans_only_what_it_has_not_seen(spark, documents):
    path = fresh(spark)
    secret = "api_key = 'abcdefgh1234'"
    first = [(1, secret), (2, secret), (3, "nothing"), (4, None)]
    base = secret_scan.scan_secrets(documents(first), path, rules=secret_scan.BASE)
    assert {r["doc_id"]: len(r["findings"]) for r in base.collect()} == {1: 1, 2: 1, 3: 0, 4: 0}
    assert spark.read.parquet(path).count() == 3
    more = first + [(5, secret), (6, "ghp_" + "Z" * 36), (7, "AKIA" + "B" * 12 + " token=secret:abcdefghij")]
    found = {r["doc_id"]: r["findings"] for r in secret_scan.scan_secrets(documents(more), path).collect()}
    read = spark.read.parquet(path)
    names = {rule.name for rule in secret_scan.BASE}
    again = [set(r["rules"]) for r in read.collect()]
    assert read.count() == 3 + 5 and sum(not (s & names) for s in again) == 3
    assert [(f["kind"], f["start"]) for f in found[6]] == [("forge_token", 0)]
    assert [(f["kind"], f["start"], f["end"]) for f in found[7]] == [("access", 0, 16)]
    assert len(found[5]) == 1
    secret_scan.scan_secrets(documents(more), path).count()
    assert spark.read.parquet(path).count() == 8


def test_ledger_returns_the_versions_asked_for(spark, documents):
    path, docs = fresh(spark), documents([(1, "one aaaa two bb")])
    old = (secret_scan.Rule("run", 1, "a+|b+"), secret_scan.Rule("word", 1, "one"))
    new = (secret_scan.Rule("word", 1, "one"), secret_scan.Rule("run", 2, "a+"))
    spans = lambda rules: [
        tuple(f) for f in secret_scan.scan_secrets(docs, path, rules=rules).first()["findings"]
    ]
    assert spans(old) == [(0, 1, "word", 3), (4, 0, "run", 8), (13, 0, "run", 15)]
    assert spans(new) == [(0, 0, "word", 3), (4, 1, "run", 8)]
    assert spans(old) == [(0, 1, "word", 3), (4, 0, "run", 8), (13, 0, "run", 15)]


def test_ledger_parts_without_rule_names_are_read_again(spark, documents):
    import hashlib

    path, rule = fresh(spark), secret_scan.Rule("run", 1, "a+")
    spark.createDataFrame(
        [(hashlib.sha256(b"one aaaa").digest(), ["run@1"], [(4, 0, "run", 8)])],
        "blob binary, rules array<string>, findings array<struct<start:int,rank:int,kind:string,end:int>>",
    ).write.parquet(path)
    found = secret_scan.scan_secrets(documents([(1, "one aaaa")]), path, rules=(rule,)).first()["findings"]
    assert [tuple(f) for f in found] == [(4, 0, "run", 8)]


def test_licenses(spark, documents):
    rows = [
        (1, "Under the MIT\nlicense, under the mit license"), (2, "CC-BY-NC and Apache License, Version 2.0"),
        (3, "is hereby granted free of charge to any person obtaining a copy of software"), (4, "undér the mit license"),
        (5, None), (6, "under the mitK license"),
    ]
    got = {r["doc_id"]: r for r in licenses.license_labels(documents(rows)).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (2, 0, 4, "mit")
    assert got[2]["base_labels"] == "apache-2,cc-by-nc" and got[2]["last_word"] == 4
    assert got[3]["n_base"] == 0 and got[3]["labels"] == "mit" and 0.8 <= got[3]["score"] < 1
    assert got[4]["n_base"] == 0 and got[6]["n_base"] == 0 and got[5]["n_words"] == 0


def test_wrapped_notices_and_telling_words(documents):
    wrapped = {
        "bsd": "* Redistribution and use in source and binary forms, with or\n * without modification, are permitted provided",
        "mit": "# Permission is hereby granted, free of charge, to\n# any person obtaining a copy\n# of this software and",
        "gpl": "This work is licensed under the GNU General\nPublic License, version 3.",
        "lgpl": "licensed under the GNU Lesser General Public License, version 2.1",
    }
    others = {100: "Released under the BSD License", 101: "released under the license", 102: "Released under\n\n\n\nthe MIT license, so"}
    rows = [*enumerate(wrapped.values()), *others.items()]
    got = {r["doc_id"]: r["labels"] for r in licenses.license_labels(documents(rows)).collect()}
    assert [got[i] for i in range(4)] == ["bsd", "mit", "gpl", "gpl,lgpl"]  # the lesser licence holds every word of the other
    assert (got[100], got[101], got[102]) == ("bsd", "", "")


def test_license_join_finds_every_block(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(12)]
    templates = [(f"t{k}", sorted(rng.sample(words, rng.randrange(3, 8)))) for k in range(10)]
    blocks = [(i, 0, sorted(set(rng.choices(words, k=rng.randrange(1, 12))))) for i in range(400)]
    frame = spark.createDataFrame(blocks, "row int, block int, words array<string>")
    got = {(r["row"], r["template"]) for r in licenses.contained_templates(frame, templates, 0.7).collect()}
    want = {(i, k) for i, _, b in blocks for k, (_, t) in enumerate(templates) if len(set(b) & set(t)) >= 0.7 * len(t) - 1e-9}
    assert got == want


def distance_by_hand(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        before, row[0] = row[:], i
        for j, d in enumerate(text, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (c != d))
    return min(row)


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(0, 80))) for _ in range(2))
        assert decontaminate.edit_distance(a, b)[0] == distance_by_hand(a, b)


def test_edit_distances_side_by_side():
    rng = random.Random(7)
    pairs = [("", "abc"), ("abc", ""), ("x", "x")]
    for size in [1, 2, 63, 64, 65, 128, 129, 300] * 30:
        pattern = "".join(rng.choice("abcdé字") for _ in range(size))
        copy = "".join(c for c in pattern if rng.random() < 0.8)
        pairs.append((pattern, "".join(rng.choice("abxy字") for _ in range(rng.randrange(60))) + copy + "b"))
    assert decontaminate.edit_distances(pairs) == [decontaminate.edit_distance(*pair)[0] for pair in pairs]


def test_places_that_agree_cover_their_hits():
    rng = random.Random(8)
    hits = [(rng.randrange(4000), rng.randrange(3), rng.randrange(40)) for _ in range(300)]
    made = decontaminate.Hits(*(np.array(c) for c in zip(*hits)))
    slack = np.array([5, 9, 30])
    one = made.agreeing(slack, np.full(3, 1))
    assert all(any(i == item and low <= at - o <= high for i, low, high in one) for at, item, o in hits)
    two = made.agreeing(slack, np.full(3, 2))
    begins = {(item, at - o, at) for at, item, o in hits}
    for item, begin, at in begins:
        near = any(i == item and (b, a) != (begin, at) and abs(b - begin) <= slack[item] for i, b, a in begins)
        assert near == any(i == item and low <= begin <= high for i, low, high in two) or not near
    assert len(two) < len(one)


def test_decontamination(spark, documents, tables):
    items = tables("SELECT item_id, text FROM '@benchmark.parquet'")
    texts = [t for (t,) in tables("SELECT text FROM '@documents.parquet' WHERE doc_id % 2 = 0 ORDER BY doc_id")]
    rng = random.Random(9)
    rows, want = [], {}
    for i, (item, text) in enumerate(items):
        words = re.sub("[a-z]", lambda m: m[0].upper(), text).split()
        if i % 2:
            for _ in range(max(1, len(words) // 20)):
                words[rng.randrange(len(words))] = "changed"
        rows.append((i, texts[i][:700] + "\n" + "  ".join(words) + "\n" + texts[i + 1][:200]))
        want[i] = item
    rows += [(900, None), (901, ""), (None, items[0][1])]
    benchmark = spark.createDataFrame([*items, (-1, None), (-2, "")], "item_id long, text string")
    frame = decontaminate.contaminated(documents(rows), benchmark)
    found = {(r["doc_id"], r["item_id"]): r["edit_distance"] for r in frame.collect()}
    assert all(found.get((i, item)) == 0 for i, item in want.items() if i % 2 == 0)
    assert sum((i, item) in found for i, item in want.items()) >= 0.95 * len(want)
    assert (None, items[0][0]) in found
    several = decontaminate.contaminated(documents(rows), benchmark, items_per_pass=7)
    assert {k for k, d in found.items() if d == 0} <= {(r["doc_id"], r["item_id"]) for r in several.collect()}
    left = decontaminate.drop_contaminated(documents(rows), benchmark)
    assert {900, 901, None} <= {r["doc_id"] for r in left.collect()} and left.columns[0] == "doc_id"
    assert decontaminate.contaminated(documents(rows), benchmark.limit(0)).count() == 0


def test_decontamination_of_a_long_text(monkeypatch):
    item = " ".join(f"word{i}" for i in range(40))
    index = decontaminate.Index.build([(5, item)], 0.99, 7)
    text = " ".join(f"x{i}" for i in range(300_000)) + " " + item + " end"
    assert index.matches([text, "none", item]) == [(0, 0, 300_000, 0), (2, 0, 0, 0)]


def test_short_items_are_found_wherever_the_edits_are():
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choices("abcdeé", k=n))
    items = [(i, " ".join(letters(rng.randrange(3, 8)) for _ in range(rng.randrange(1, 16)))) for i in range(40)]
    index = decontaminate.Index.build(items, 0.99, 7)
    texts = ["", "a"]
    for _, item in items:
        chars = list(item)
        for at in rng.sample(range(len(chars)), len(chars) // 5):
            chars[at] = rng.choice(["", "f", chars[at] + "g"])
        edge = lambda: " ".join(letters(4) for _ in range(rng.randrange(4)))
        texts.append(f"{edge()} {''.join(chars)} {edge()}")
    words = [b" ".join(decontaminate.words_of(t)).decode() for t in texts]
    want = {
        (t, i): d for t, text in enumerate(words) for i, item in items
        if (d := decontaminate.edit_distance(item, text)[0]) <= int(0.2 * len(item) + 1e-9)
    }
    assert {(t, i): d for t, i, _, d in index.matches(texts)} == want and len(want) >= 40
    # Every word edited, the first one too.
    assert decontaminate.Index.build([(1, "abcde fghij klmno pqrst")], 0.99, 7).matches(["x abcdf fghik klmnp pqrsu"])


def _changed(rng, text, share, whole_words=False):
    letter = lambda: rng.choice("abcdefghilmnorstu")
    if whole_words:
        words = text.split()
        for at in rng.sample(range(len(words)), round(share * len(words))):
            words[at] = "".join(letter() for _ in range(5))
        return " ".join(words)
    chars = list(text)
    for at in rng.sample(range(len(chars)), round(share * len(chars))):
        chars[at] = rng.choice([letter(), "", chars[at] + letter()])
    return "".join(chars)


@pytest.mark.parametrize("share, whole_words", [(0.02, False), (0.1, False), (0.15, False), (0.18, False), (0.1, True), (0.15, True)])
def test_edited_copies_are_found_as_by_brute_force(tables, share, whole_words):
    """Items of all lengths against whole texts; every row is compared with the exact distance of the pair."""
    rng = random.Random(int(share * 100))
    items = tables("SELECT item_id, text FROM '@benchmark.parquet'")
    texts = [t or "" for (t,) in tables("SELECT text FROM '@documents.parquet' WHERE length(text) < 3000 ORDER BY doc_id")]
    copies = [f"{texts[i]}\n{_changed(rng, item, share, whole_words)} {texts[i + 1]}" for i, (_, item) in enumerate(items)]
    index = decontaminate.Index.build(items, decontaminate.RECALL, 7)
    found = {(t, i): d for t, i, _, d in index.matches(copies)}
    true = {}
    for number, text in enumerate(copies):
        plain = decontaminate.plain(text)
        for item in {number, (number + 1) % len(items)} | {i for t, i in found if t == number}:
            distance, _ = decontaminate.edit_distance(index.texts[item], plain)
            if distance <= index.limits[item]:
                true[number, item] = distance
    assert all(true.get(pair) == distance for pair, distance in found.items())
    assert len(found) >= (0.99 if share <= 0.1 or whole_words else 0.9) * len(true) and len(true) >= 0.9 * len(items)


def test_clean_texts_are_left_alone(tables):
    items = tables("SELECT item_id, text FROM '@benchmark.parquet'")
    index = decontaminate.Index.build(items, decontaminate.RECALL, 7)
    texts = [t or "" for (t,) in tables("SELECT text FROM '@documents.parquet' WHERE length(text) < 1500 ORDER BY doc_id LIMIT 60")]
    true = {
        (t, i): d for t, text in enumerate(map(decontaminate.plain, texts)) for i, item in enumerate(index.texts)
        if (d := decontaminate.edit_distance(item, text)[0]) <= index.limits[i]
    }
    assert {(t, i): d for t, i, _, d in index.matches(texts)} == true


def test_best_fit():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 40) for _ in range(500)]
    into, offset, fill = packing.best_fit(sizes, 64)
    placed = collections.defaultdict(list)
    for size, at, place in zip(sizes, into, offset):
        placed[at].append((place, size))
    for at, items in placed.items():
        end = 0
        for place, size in sorted(items):
            assert place == end
            end += size
        assert end == fill[at] <= 64
    assert len(fill) <= -(-sum(sizes) // 64) + 2



def test_planned_best_fit_is_best_fit():
    rng = random.Random(4)
    for _ in range(40):
        sizes = [rng.randrange(1, 65) for _ in range(rng.randrange(1, 300))]
        filled, ends, seen = collections.defaultdict(list), {}, collections.defaultdict(set)
        for size, low, high, first, offset, whole in packing.plan_best_fit(collections.Counter(sizes), 64):
            seen[size] |= set(range(low, high))
            for i in range(high - low):
                filled[first + i].append((offset, size))
                ends.setdefault(first + i, whole) if offset == 0 else None
        assert {s: len(n) for s, n in seen.items()} == collections.Counter(sizes)
        for at, items in filled.items():
            end = 0
            for offset, size in sorted(items):
                assert offset == end
                end += size
            assert end == ends[at] <= 64
        assert sorted(ends.values()) == sorted(packing.best_fit(sizes, 64)[2])


def test_merging_closes_no_underfull_bin(spark):
    bins = spark.range(120_000).selectExpr(
        "id AS bin", "IF(id < 60000, 1500L, 500L) AS fill", "CAST(0 AS int) AS part"
    )
    merged = packing._merge(bins, 2048, 1)
    rows = merged.groupBy("into").sum().selectExpr("count(*) AS n").first()
    assert rows["n"] == 60_000 and merged.where("at = 0 AND filled <> 2000").isEmpty()


@pytest.mark.parametrize("fan_in,parts", [(2, 7), (8, 3)])
def test_packing_round_trip(spark, documents, sample, fan_in, parts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    rows = sample + [(900, None), (901, "a  b \n c<|endoftext|> d　 e "), (902, " lead"), (903, "x" * 30_000)]
    docs = documents(rows).repartition(parts)
    got = packing.pack_documents(docs, BPE, fan_in=fan_in, with_ids=True).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and 4 * r["length"] == len(r["ids"])
    total = 0
    for i, text in rows:
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted(pieces[i], key=lambda r: r["piece"])
        ids = b"".join(bytes(r["ids"]) for r in own)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want
        assert [r["start"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own[:-1]]))
        assert all(r["length"] == 2048 for r in own[1:]) and (len(own) == 1 or len(want) > 2048)
        total += len(want)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= 1.1 * total / 2048 + parts
