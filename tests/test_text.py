import re
from html.parser import HTMLParser
from pathlib import PurePosixPath

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from srcsieve.functions import text as X

LOOSE = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
# The JVM and Python know different Unicode versions, so newer letters are left out.
CHARS = st.one_of(st.characters(max_codepoint=0x52F), st.sampled_from("日本語한글ก😀𝒜\u2028\u3000"))


def evaluate(spark, expression, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_file_suffix(spark):
    names = [
        "a.tar.gz", ".gitignore", "d/.gitignore", "foo.", "..a", "A.R", "noext", "d.x/noext", "a/b.PY",
        "x..py", ".a.b", "a b.c d", "", "dir.d/.x.y",
    ]
    assert evaluate(spark, X.file_suffix("t"), names) == [PurePosixPath(n).suffix.lower() for n in names]


def without_magics(code: str) -> str:
    return "\n".join(line for line in code.splitlines() if line.lstrip()[:1] not in ("%", "!") or not line.lstrip())


BREAKS = ["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " "]


def test_strip_notebook_magics(spark):
    texts = [f"a{b}%x{b}  !y{b}{b}z{b}" for b in BREAKS] + ["", "%", "%a\n%b", "\n", "\n\n", " %x\ny", "a%\nb!", "\x1f!q"]
    assert evaluate(spark, X.strip_notebook_magics("t"), texts) == [without_magics(t) for t in texts]


@LOOSE
@given(
    st.lists(
        st.lists(st.sampled_from(list("ab%! \t\u3000") + BREAKS), max_size=12).map("".join), min_size=40, max_size=60
    )
)
def test_strip_notebook_magics_any(spark, texts):
    assert evaluate(spark, X.strip_notebook_magics("t"), texts) == [without_magics(t) for t in texts]


@LOOSE
@given(st.lists(st.text(CHARS, max_size=20), min_size=40, max_size=60))
def test_scores_any(spark, texts):
    got = evaluate(spark, F.struct(X.line_count("t"), X.alpha_ratio("t"), X.token_count("t"), X.is_blank("t")), texts)
    for text, (lines, alpha, tokens, blank) in zip(texts, got):
        assert lines == text.count("\n") + 1
        assert tokens == len(re.findall(r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\f\r]", text))
        assert blank == (not text.strip())
        if text:
            assert abs(alpha - sum(c.isalpha() for c in text) / len(text)) < 1e-9
        else:
            assert alpha is None


def test_capitalise(spark):
    words = ["python", "javaScript", "R", "c++", "", "éa B"]
    assert evaluate(spark, X.capitalise("t"), words) == [w.capitalize() for w in words]


class Visible(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def test_visible_chars(spark):
    pages = [
        "<p>one &amp; two</p>", "<script>if (a < b) x('<b>')</script>after", "<style>p { }</style><b>x</b>",
        "a<!-- <p>no</p> -->b", "<!DOCTYPE html><html><body>t</body></html>", "1 < 2 &#65; &#x41;", "",
        "seen<script>never closed <b>x</b>",
    ]
    want = []
    for page in pages:
        parser = Visible()
        parser.feed(page)
        parser.close()
        want.append(len("".join(parser.parts)))
    assert evaluate(spark, X.visible_chars("t"), pages) == want


def test_unclosed_markup_takes_linear_time(spark):
    pages = ["<script " * 40_000, "<!--" * 100_000, "<script>" * 60_000, "<a" * 100_000]
    assert evaluate(spark, X.visible_chars("t"), pages) == [0, 0, 0, 0]


def test_malformed_and_unknown_sections(spark):
    texts = ["<![ x", "<![if x]>", "<![CDATA[x]]>", "<![foo[x]]>", "<![é", "<![_", "a\x01b", "a\tb\r\nc", None]
    bad = [bool(re.search(r"(<!\[[^\w])|([\x00-\x08\x0B\x0C\x0E-\x1F])", t or "")) for t in texts]
    assert evaluate(spark, X.has_malformed_html("t"), texts) == bad
    unknown = evaluate(spark, F.coalesce(X.has_unknown_section("t"), F.lit(False)), texts)
    assert unknown == [True, False, False, True, True, True, False, False, False]


def test_chars_per_token(spark):
    assert evaluate(spark, X.chars_per_token("t"), ["ab cd", "  ", "", None]) == [2.5, -1.0, -1.0, None]
