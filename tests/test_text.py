import pytest
from pyspark.sql import functions as F

from gleaner.functions import text


def value(spark, x, expr):
    return spark.createDataFrame([(x,)], "x string").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("html", "plain"),
    [
        ("<html><head><title>Harbour</title><style media=print>a{}</style><SCRIPT type='x'>let s='<i>';</SCRIPT></head><body><p>Salt &amp; wind</p><!-- a\nb -->\nHigh tide.</body></html>", "Harbour Salt & wind High tide."),
        ("<div>Lone</div>", "Lone"),
        ("a<script x</script>b</script>c", "a c"),
        ("<scripted>kept</scripted>", "kept"),
        ("&lt;b&gt; &amp;lt; a&nbsp;b", "<b> &lt; a b"),
        ("", ""),
    ],
)
def test_html(spark, html, plain):
    assert value(spark, html, text.html_plaintext) == plain


@pytest.mark.parametrize(("x", "n", "y"), [("aé", 2, "a"), ("aé", 3, "aé"), ("日本", 2, ""), ("日本", 5, "日"), ("😀", 3, ""), ("abc", 10, "abc"), ("", 3, "")])
def test_truncation_keeps_characters(spark, x, n, y):
    assert value(spark, x, lambda c: text.utf8_truncate(c, n)) == y


def test_tokens(spark):
    assert value(spark, "abc中文 中文abc 3.5 foo_bar", lambda c: text.tokens(text.normalize(c))) == ["abc中文", "中", "文", "abc", "3", "5", "foo", "bar"]


def test_nfkc(spark):
    assert value(spark, "ＡＢＣ ﬁ", text.normalize) == "abc fi"


def test_clean_keywords(spark):
    raw = [" tide / ebb ", "潮汐，退潮", "q", "b" * 61, "tide"]
    got = spark.createDataFrame([(raw,)], "x array<string>").select(text.clean_keywords(F.col("x")).alias("y")).first().y
    assert got == ["tide", "ebb", "潮汐", "退潮"]


def test_languages(spark):
    assert value(spark, "fra, deu,,", text.language_list) == ["fra", "deu"]
    for wanted, ok in ((None, True), (["deu"], True), (["ita"], False), ([], False)):
        assert value(spark, "fra,deu", lambda c, w=wanted: text.accepts(c, w)) is ok
    assert value(spark, "", lambda c: text.accepts(c, ["deu"])) is False


@pytest.mark.parametrize(("said", "ok"), [(" **None.** ", False), ("`空`", False), ("N/A", False), ("​", False), ("A strategy.", True), ("", False), ("no findings", False)])
def test_informative(spark, said, ok):
    assert value(spark, said, text.informative) is ok


def test_malformed_bytes_are_dropped(spark):
    got = spark.createDataFrame([(bytearray(b"a\xffb\xe2\x82"),)], "x binary").select(text.drop_malformed(F.col("x")).alias("y")).first().y
    assert got == "ab"


def test_header_values(spark):
    assert value(spark, "12x", text.parse_length) is None
    assert value(spark, "0120", text.parse_length) == 120
    assert str(value(spark, "2026-03-03T00:00:07Z", text.parse_date)) == "2026-03-03 00:00:07"
