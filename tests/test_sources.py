import gzip
import json

from pyspark.sql import functions as F

from srcsieve.constants import EXCLUDED_EXTENSIONS
from srcsieve.operators import discovery as D
from srcsieve.operators import files as FI
from srcsieve.operators import languages as L
from srcsieve.operators import seen as S
from srcsieve.sources import records as R
from srcsieve.sources.archive import archive_paths, read_archive_events
from srcsieve.sources.metadata import read_repo_metadata
from srcsieve.sources.tree import decode_text, list_source_files, read_source_tree


def event(name, kind="PushEvent"):
    return json.dumps({"type": kind, "repo": {"name": name}, "created_at": "2025-01-01T00:00:00Z"})


def test_archive_damage(spark, tmp_path):
    good = tmp_path / "2025-01-01-0.json.gz"
    good.write_bytes(gzip.compress("\n".join([event("a/a"), "{broken", "", event("b/b"), "[1]", "{}"]).encode()))
    cut = tmp_path / "2025-01-01-1.json.gz"
    whole = gzip.compress("\n".join(event(f"c/{i}") for i in range(20_000)).encode())
    cut.write_bytes(whole[: len(whole) // 2])
    names = [r.repo_name for r in read_archive_events(spark, str(tmp_path)).collect()]
    assert {"a/a", "b/b", "c/0"} <= set(names)
    assert 3 < len(names) < 20_002


def test_repo_rules(spark, tmp_path):
    def response(name, stars=50, size=50_000, language="Python", **more):
        return {"full_name": name, "stargazers_count": stars, "size": size, "language": language, **more}

    rows = [
        response("a/ok", license={"key": "mit"}, default_branch="dev", description=None),
        response("a/49", stars=49), response("a/none", stars=None), response("a/small", size=49_999),
        response("a/top", size=1_000_000, license=None), response("a/big", size=1_000_001),
        response("a/nolang", language=None), response("a/go", language="Go"), response("a/case", language="python"),
    ]
    (tmp_path / "r.json").write_text("\n".join(map(json.dumps, rows)) + "\nnot json\n")
    meta = D.project_repo_metadata(read_repo_metadata(spark, str(tmp_path)))
    languages = L.exclude_languages(spark.createDataFrame([(0, "Python", [".py"]), (1, "Go", [".go"])], "pos long, language string, extensions array<string>"))
    chosen = {r.repo_name: r for r in D.select_repos(meta, languages).collect()}
    assert set(chosen) == {"a/ok", "a/top"}
    assert chosen["a/ok"].license == "mit" and chosen["a/top"].license == "null"
    assert chosen["a/top"].default_branch == "main" and chosen["a/ok"].description is None
    reasons = {r.repo_name: r.reason for r in D.repo_reject_reason(meta, languages).collect()}
    assert reasons["a/none"] == reasons["a/49"] == "insufficient stars"
    assert reasons["a/small"] == reasons["a/big"] == "invalid size"
    assert (reasons["a/nolang"], reasons["a/go"], reasons["a/ok"]) == ("no language", "unsupported language", None)


def test_first_seen_order(spark):
    rows = [("b/b", 0, 0), ("a/a", 0, 1), ("b/b", 1, 0), ("c/c", 1, 1)]
    events = spark.createDataFrame(rows, "repo_name string, hour int, line int")
    assert [r.repo_name for r in D.first_n_repos(events, ["hour", "line"], 2).collect()] == ["b/b", "a/a"]


def test_language_dimension(spark, tmp_path):
    (tmp_path / "languages.json").write_text(
        json.dumps({"C": [".c", ".h"], "C++": [".cpp", ".H"], "None": None, "JS": [".js", "Jakefile"], "Go": [".go"]}, indent=1)
    )
    lang_map = L.read_language_map(spark, str(tmp_path / "languages.json"))
    dim = {r.extension: r.language for r in L.extension_language_dim(lang_map).collect()}
    assert dim == {".c": "C", ".h": "C++", ".cpp": "C++", ".js": "JS", ".go": "Go"}
    tokens = {r.extension for r in L.supported_extensions(L.exclude_languages(lang_map)).collect()}
    assert tokens == {".c", ".h", ".cpp", ".H", ".js", "Jakefile"}
    files = spark.createDataFrame([("x.H",), ("",), (None,), ("Jakefile",), ("a/b.cpp",)], "file_name string")
    got = L.detect_language(files, L.extension_language_dim(lang_map)).collect()
    assert {r.file_name: r.language for r in got} == {
        "x.H": "C++", "": "Unknown", None: "Unknown", "Jakefile": "Unknown", "a/b.cpp": "C++",
    }


def test_tree_and_records(spark, tmp_path):
    repo = tmp_path / "o__a__b"
    contents = {
        "src/__init__.py": b"x = 1\n", "_hidden/.x.py": b"", "a.tar.gz": b"\x1f\x8bnot gzip", "lib/venv/z.py": b"z",
        "venv.py": b"v", "README.md": b"doc", ".gitignore": b"x", "UPPER.PY": "é".encode("latin-1"), "deep/er/a b.py": b"q",
    }
    for name, content in contents.items():
        (repo / name).parent.mkdir(parents=True, exist_ok=True)
        (repo / name).write_bytes(content)
    (tmp_path / "not_selected").mkdir()
    (tmp_path / "not_selected" / "a.py").write_bytes(b"n")
    repos = spark.createDataFrame([("o/a__b",), ("o/absent",)], "repo_name string")
    tree = {r.file_name: (r.repo_name, r.length, bytes(r.content)) for r in read_source_tree(repos, str(tmp_path)).collect()}
    assert tree == {n: ("o/a__b", len(c), c) for n, c in contents.items()}
    extensions = spark.createDataFrame([(".py",), (".md",), (".gz",)], "extension string")
    valid = FI.valid_code_files(list_source_files(repos, str(tmp_path)), extensions)
    names = {r.file_name for r in valid.collect()}
    assert names == {"src/__init__.py", "_hidden/.x.py", "a.tar.gz", "venv.py", "UPPER.PY", "deep/er/a b.py"}
    meta = spark.createDataFrame(
        [("o/a__b", None, 60, "main", "mit", 70_000, "Python")],
        "repo_name string, description string, stars long, default_branch string, license string, size long, language string",
    )
    dim = spark.createDataFrame([(".py", "Python")], "extension string, language string")
    texts = valid.withColumn("text", F.when(F.col("file_name") != "venv.py", F.lit("t")))
    records = FI.assemble_code_records(texts, FI.file_counts(valid), meta, dim).collect()
    assert len(records) == 5 and {r.file_count for r in records} == {6}
    assert {r.file_name: r.language for r in records}["a.tar.gz"] == "Unknown"


def test_exclusions_are_all_lower_case():
    assert all(e == e.lower() and e.startswith(".") for e in EXCLUDED_EXTENSIONS)


def test_decode(spark):
    text = "naïve café — 日本"
    cases = [
        (text.encode(), text), (text.encode("utf-16"), text), (b"\xef\xbb\xbf" + text.encode(), text),
        (text.encode("utf-32"), text), ("naïve café".encode("latin-1"), "naïve café"), (b"it\x92s", "it’s"),
        (b"a" * 3000 + b"\xff" + "é".encode(), "a" * 3000 + "é"), (b"", ""),
        (b"a" * 2047 + "é".encode() + b"\xff", "a" * 2047 + "é"), (None, None),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "id int, content binary")
    got = {r.id: r.text for r in decode_text(df).collect()}
    assert got == {i: t for i, (_, t) in enumerate(cases)}
    head = b"a" * 2048 + "é".encode() + b"z"
    df = spark.createDataFrame([(0, head), (1, "é".encode() + head)], "id int, content binary")
    got = {r.id: r.text for r in decode_text(df, ascii_head="drop").collect()}
    assert got == {0: "a" * 2048 + "z", 1: "é" + head.decode()}


def test_decode_guesses_unmarked_encodings(spark):
    lines = {
        "shift_jis": "# この関数は配列の合計を計算して結果を返します。\nx = 1\n",
        "euc_jp": "# ファイルを開いて、データを読み込む\nprint(a)\n",
        "gb18030": "// 这个函数用来计算数组中的所有元素的和\nint a;\n",
        "big5": "// 這個函數是用來計算陣列中的所有元素的和\nint a;\n",
        "euc_kr": "# 이 함수는 배열의 합계를 계산하고 결과를 반환한다\n",
        "cp1251": "// Функция возвращает сумму элементов массива\n",
        "koi8-r": "// Функция возвращает сумму элементов массива\n",
        "cp866": "// Функция возвращает сумму элементов массива\n",
        "utf-16-le": "int main() { return 0; } // é\n",
        "utf-16-be": "int main() { return 0; } // é\n",
        "cp1252": "# Müller’s “Größe” … «été»\n",
        "latin-1": "# coût élevé, où ça? Ünïcödé naïveté\n",
    }
    df = spark.createDataFrame([(k, t.encode(k)) for k, t in lines.items()], "id string, content binary")
    assert {r.id: r.text for r in decode_text(df).collect()} == lines
    binary = spark.createDataFrame([(0, b"a\x00b"), (1, b"\x00"), (2, "é\x00".encode())], "id int, content binary")
    assert {r.id: r.text for r in decode_text(binary).collect()} == {0: "a\x00b", 1: "\x00", 2: "é\x00"}


def test_records_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("o/a", None, 1, 2, 3, "R", "mit", "a.R", "é ☃\n", m, b) for m in ("january", "may") for b in (0, 1)]
    columns = [*R.CODE_RECORD.fieldNames(), "month", "batch"]
    df = spark.createDataFrame(rows, "{} string, {} string, {} long, {} long, {} long, {} string, {} string, {} string, {} string, {} string, {} int".format(*columns))
    R.write_code_records(df, path, ("month", "batch"))
    R.write_code_records(df.where("month = 'may' AND batch = 1").withColumn("text", F.lit("new")), path, ("month", "batch"))
    back = R.read_code_records(spark, path, "may").orderBy("batch").collect()
    assert [(r.text, r.month, r.batch) for r in back] == [("é ☃\n", "may", 0), ("new", "may", 1)]
    raw = next((tmp_path / "out" / "month=january" / "batch=0").glob("*.json")).read_text()
    assert "☃" in raw and '"description":null' in raw


def test_corrupt_records(spark, tmp_path):
    (tmp_path / "output_1.jsonl").write_text('{"repo_name": "o/a", "text": "x"}\n\n{"repo_name": \n')
    (tmp_path / "other.jsonl").write_text('{"repo_name": "o/b"}\n')
    path = str(tmp_path)
    assert [r.repo_name for r in R.read_code_records(spark, path, pattern="output*.jsonl").collect()] == ["o/a"]
    every = R.read_code_records(spark, path, pattern="output*.jsonl", keep_corrupt=True).collect()
    assert [r[R.CORRUPT] for r in every if r.repo_name is None] == ['{"repo_name": ']


def test_batches_hold_ten_repositories(spark):
    df = spark.createDataFrame([(f"o/{i % 25}", i) for i in range(100)], "repo_name string, seq int")
    got = R.assign_output_batches(df, ["seq", "repo_name"], 7).collect()
    assert {(r.repo_name, r.batch) for r in got} == {(f"o/{i}", 7 + i // 10) for i in range(25)}
    empty = spark.createDataFrame([], "batch long")
    assert R.next_output_index(empty).first().next_batch == 0


def test_resume_is_idempotent(spark):
    new = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "repo_name string, x int")
    done = new.where("x = 1")
    once = S.resume_partial_batch(done, new)
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 3)]
    assert sorted(map(tuple, S.resume_partial_batch(once, new).collect())) == [("a", 1), ("b", 3)]


def test_absent_hours_are_skipped(spark, tmp_path):
    for hour in (0, 2):
        (tmp_path / f"2025-01-01-{hour}.json.gz").write_bytes(gzip.compress(event(f"a/{hour}").encode()))
    bounds = spark.sql("SELECT TIMESTAMP '2025-01-01 00:00:00' AS s, TIMESTAMP '2025-01-01 03:00:00' AS e")
    paths = archive_paths(bounds, "s", "e", f"{tmp_path}/")
    assert paths.count() == 4
    assert sorted(r.repo_name for r in read_archive_events(spark, paths).collect()) == ["a/0", "a/2"]
    assert read_archive_events(spark, [f"{tmp_path}/none.json.gz"]).count() == 0


def record(name, text, month="1"):
    return (name, None, 1, 1, 1, "Python", "mit", "a.py", text, month)


RECORDS = "repo_name string, description string, stars long, file_count long, size_kb long, language string, license string, file_name string, text string, month string"


def test_a_record_of_any_length_is_read(spark, tmp_path):
    rows = spark.createDataFrame([record("a/a", "x"), record("a/b", "y")], RECORDS)
    long = rows.withColumn("text", F.when(F.col("repo_name") == "a/b", F.repeat("text", F.lit(21_000_000))).otherwise(F.col("text")))
    R.write_code_records(long, str(tmp_path / "out"))
    got = R.read_code_records(spark, str(tmp_path / "out")).select("repo_name", F.length("text").alias("n"))
    assert sorted(map(tuple, got.collect())) == [("a/a", 1), ("a/b", 21_000_000)]


def test_a_rerun_that_keeps_nothing_leaves_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([record("a/a", "x", "1"), record("a/b", "y", "2")], RECORDS)
    R.write_code_records(rows, out)
    months = spark.createDataFrame([("1",)], "month string")
    R.write_code_records(rows.where("false"), out, replace=months)
    assert [r.repo_name for r in R.read_code_records(spark, out).collect()] == ["a/b"]


def test_listing_does_not_depend_on_levels(spark, tmp_path):
    names = ["a.py", "x/b.py", "x/y/c.py", "x/y/z/d.py", "x/y/z/w/e.py", "v/w/f.py"]
    for name in names:
        (tmp_path / "o__deep" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "o__deep" / name).write_text("12345")
    (tmp_path / "o__deep" / "empty" / "inner" / "most").mkdir(parents=True)
    repos = spark.createDataFrame([("o/deep",), ("o/none",)], "repo_name string")
    for levels in (1, 2, 3, 9):
        got = sorted(map(tuple, list_source_files(repos, str(tmp_path), levels).collect()))
        assert got == sorted(("o/deep", name, 5) for name in names)
