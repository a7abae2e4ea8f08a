import json

from srcsieve.operators import notebooks as N

NB = "Jupyter Notebook"


def cell(source, kind="code"):
    return {"cell_type": kind, "source": source, "outputs": [{"data": "x" * 50}]}


def frame(spark, notebooks):
    rows = [(i, NB, n if isinstance(n, str) or n is None else json.dumps(n)) for i, n in enumerate(notebooks)]
    return spark.createDataFrame(rows, "id int, language string, text string")


def info(name="python"):
    return {"language_info": {"name": name}}


def test_cells(spark):
    cells = [
        cell(["a\n", "b"]), cell("[1, 2]"), cell('["x", "y"]'), cell(None), {"cell_type": "code"}, cell(5), cell(True),
        cell("no", "markdown"), {"source": "no"},
    ]
    got = N.notebook_code_cells(frame(spark, [{"cells": cells}])).first().cells
    assert got == ["a\nb", "[1, 2]", '["x", "y"]', "None", "", "5", "True"]


def test_language_tiers(spark):
    one = [cell("x = 1")]
    notebooks = [
        {"cells": one, "metadata": info("javaScript")},
        {"cells": one, "metadata": {"language_info": {}}, "kernelspec": {"language": "R"}},
        {"cells": one, "kernelspec": {"language": "julia", "name": "julia-1"}},
        {"cells": one, "kernelspec": {"name": "ir"}},
        {"cells": one, "metadata": {"kernelspec": {"name": "ir", "language": "R"}}},
        {"cells": one},
    ]
    def languages(place):
        return {r.id: r.language for r in N.process_notebooks(frame(spark, notebooks), place).collect()}

    assert languages("top") == {0: "Javascript", 1: "Unknown", 2: "Julia", 3: "Ir"}
    assert languages("metadata") == {0: "Javascript", 1: "Unknown", 4: "R"}
    assert languages("both") == {0: "Javascript", 1: "Unknown", 2: "Julia", 3: "Ir", 4: "R"}


def test_dropped_and_logged(spark):
    good = {"cells": [cell("x")], "metadata": info()}
    notebooks = [
        good, '{"cells": [', "", "  \n", None, "[]", '"text"', "7", json.dumps(good) + " extra",
        json.dumps(good) + "," + json.dumps(good), "{'cells': []}",
        {"cells": [], "metadata": info()}, {"cells": [cell("%magic\n  !ls")], "metadata": info()},
        {"metadata": info()}, {"cells": [cell(" \n\t")], "metadata": info()},
    ]
    df = frame(spark, notebooks)
    assert [(r.id, r.text) for r in N.process_notebooks(df).collect()] == [(0, "x")]
    issues = {r.id: r.issue for r in N.notebook_issues(df, ["id"]).collect()}
    assert issues == {i: N.MALFORMED for i in (1, 5, 6, 7, 8, 9, 10)}
    assert N.empty_notebook_count(df, ["language"]).first().empty_notebooks == 4


def test_other_files_pass_unchanged(spark):
    rows = [(0, "Python", "{"), (1, None, ""), (2, "jupyter notebook", "  "), (3, "R", None)]
    df = spark.createDataFrame(rows, "id int, language string, text string")
    assert [tuple(r) for r in N.process_notebooks(df).orderBy("id").collect()] == rows


def test_large_and_odd_json(spark):
    big = {"cells": [cell("y" * 25_000_000)], "metadata": info(), "junk": ["z" * 1000] * 100}
    twice = '{"cells": [], "cells": [{"cell_type": "code", "source": "last"}], "metadata": {"language_info": {"name": "r"}}, "x": NaN}'
    got = {r.id: (r.language, len(r.text)) for r in N.process_notebooks(frame(spark, [big, twice])).collect()}
    assert got == {0: ("Python", 25_000_000), 1: ("R", 4)}


def test_what_the_jvm_parser_refuses_is_read_again(spark):
    code = '{"cells": [{"cell_type": "code", "source": "a = 1", "outputs": [%s]}], "metadata": {"language_info": %s}}'
    named = '{"name": "python"}'
    texts = [
        code % ("7" * 1500, named), code % ("0." + "7" * 1500, named), code % ('{"%s": 1}' % ("k" * 60_000), named),
        code % ("1", '{"name": "julia", "name": "python"}'), code % ("1", named) + " tail",
    ]
    got = {r.id: (r.text, r.language) for r in N.process_notebooks(frame(spark, texts)).collect()}
    assert got == {i: ("a = 1", "Python") for i in range(4)}
    assert [r.id for r in N.notebook_issues(frame(spark, texts), ["id"]).collect()] == [4]
