import pandas as pd
import pytest
from pyspark.sql import functions as F

from srcsieve.operators import quality as G

BODY = "let the words of this line be long enough"


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, lang, text, 1, 1) for i, (lang, text) in enumerate(rows)],
        "id int, language string, text string, month int, batch int",
    )


def kept(df):
    return sorted(r.id for r in df.select("id").collect())


def test_line_bounds(spark):
    df = frame(spark, [(None, "\n".join(["x"] * n)) for n in (4, 5, 10_000, 10_001)] + [(None, None)])
    assert kept(G.loc_filter(df)) == [1, 2]


def test_alpha_bounds_and_empty_text(spark):
    df = frame(spark, [(None, "a111"), (None, "a1111"), (None, ""), (None, None)])
    assert kept(G.alpha_filter(df)) == [0]


def test_other_and_null_languages_pass(spark):
    header = '<?xml version="1.0"?>' + BODY
    df = frame(spark, [("XML", header), ("Python", header), (None, header), ("xml", "x" * 90 + header), ("xml", "x" * 60 + header)])
    assert kept(G.xml_header_filter(df)) == [1, 2, 3]


def test_html_rules(spark):
    df = frame(spark, [
        ("HTML", "x" * 100), ("HTML", "x" * 101), ("html", "x" * 101 + "<a href='" + "y" * 500 + "'>"),
        (None, "x"), ("HTML", "\x01" + "x" * 200), ("HTML", None), ("html", "<![ " + "x" * 200),
    ])
    assert kept(G.html_filter(df)) == [1, 3]


def test_fertility(spark):
    df = frame(spark, [(None, "ab cd"), (None, "a b"), (None, " "), (None, None)])
    assert kept(G.token_fertility_filter(df)) == [0]


def test_model_tokenizer(spark, tmp_path):
    import sentencepiece

    corpus = tmp_path / "corpus.txt"
    corpus.write_text("\n".join([BODY, "def main(): return 1", "words of many kinds"] * 50))
    sentencepiece.SentencePieceTrainer.train(
        input=str(corpus), model_prefix=str(tmp_path / "m"), vocab_size=32, minloglevel=2
    )
    model = str(tmp_path / "m.model")
    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = [BODY, "zq9 #!%", "return words", ""]
    want = [i for i, t in enumerate(texts) if t and len(t) / len(processor.encode(t)) >= 2.0]
    df = frame(spark, [(None, t) for t in texts])
    assert kept(G.token_fertility_filter(df, 2.0, model)) == want
    chained = G.quality_filter_chain(frame(spark, [(None, "\n".join([BODY] * 6))]), model)
    assert chained.columns[-2:] == ["loc", "alpha"]
    chained.collect()


@pytest.mark.parametrize("scope,flags", [((), [True, False]), (("month", "batch"), [True, True, True])])
def test_fallback(spark, scope, flags):
    text = "\n".join([BODY] * 6)
    hidden = "<script>" + text + "</script>"
    df = frame(spark, [("HTML", "<![foo[x]]>" + text), ("HTML", hidden), ("Python", text)])
    got = G.filter_with_fallback(df, scope).orderBy("id").collect()
    # By record the hidden page is dropped; by file the unreadable page switches the rule off.
    assert [r.html_skipped for r in got] == flags
    assert G.quality_filter_chain_no_html(df).count() == 3


def test_score_is_stored_only_if_named(spark):
    df = frame(spark, [(None, "abc"), (None, "a")])
    assert G.score_filter(df, F.length("text"), lambda n: n > 1).columns == df.columns
    assert [r.n for r in G.score_filter(df, F.length("text"), lambda n: n > 1, "n").collect()] == [3]


def test_the_tokenizer_sees_only_rows_that_reach_it(spark, monkeypatch):
    from pyspark.sql import functions as F, types as T

    from srcsieve.operators import quality

    seen = spark.sparkContext.accumulator(0)

    def counted(path):
        @F.pandas_udf(T.IntegerType())
        def tokens(texts: pd.Series) -> pd.Series:
            seen.add(int(texts.notna().sum()))
            return texts.str.len().astype("Int32")

        return tokens

    monkeypatch.setattr(quality, "model_token_count", counted)
    good = "\n".join(f"some plain words number {i}" for i in range(10))
    rows = spark.createDataFrame([("Python", good if i < 10 else "1") for i in range(200)], "language string, text string")
    quality.filter_report(rows, tokenizer="model").collect()
    assert seen.value == 10
