"""Text functions. All are native expressions but NFKC, which no built-in offers."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# HTML entities that are decoded. The ampersand comes last, so that one pass suffices.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
# What is blanked out of HTML, in this order.
MARKUP = [r"(?s)<!--.*?-->", r"(?is)<script\b[^>]*>.*?</script>", r"(?is)<style\b[^>]*>.*?</style>", r"<[^>]+>"]
# Unicode white space.
BLANKS = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
# One character of a script without spaces, or a run of letters and digits.
TOKEN = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]|[\p{L}\p{N}]+"
#: The same tokens of lower-cased text, with the run that begins with an ASCII letter or digit tried first.
_FAST_TOKEN = r"[a-z0-9]++[\p{L}\p{N}]*+|" + TOKEN
#: Texts of these characters are in NFKC: ASCII, letters of Latin-1 with accents, basic Cyrillic, Han, Hangul, kana.
_STABLE = r"^[\x00-\x7f\xc0-\xff\x{410}-\x{44f}\x{4e00}-\x{9fff}\x{ac00}-\x{d7a3}\x{3041}-\x{3096}\x{30a1}-\x{30fa}]*+$"
# Characters that a finding is stripped of, and replies that say there is none.
FINDING_TRIM = " \n\t\r`\"'*().\u00b7-\u200b\ufeff\u3000\u7a7a"
NO_FINDING = ["empty", "empty string", "none", "null", "n/a", "na", "nil", "no findings", "nothing", "no strategy", "no trading strategy"]
# Separators in keyword lists, and the length of a keyword.
KEYWORD_SEPARATORS = "[,/|;\u3001\uff0c]+"
KEYWORD_LENGTHS = (2, 60)


def ascii_lower(x: Column) -> Column:
    """A-Z only, as byte-wise case folding does."""
    return F.translate(x, UPPER, LOWER)


def decode_entities(x: Column) -> Column:
    for name, char in ENTITIES:
        x = F.replace(x, F.lit(name), F.lit(char))
    return x


def collapse(x: Column) -> Column:
    """Unicode white space to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(x, BLANKS, " "))


def html_plaintext(html: Column) -> Column:
    for pattern in MARKUP:
        html = F.regexp_replace(html, pattern, " ")
    return collapse(decode_entities(html))


def utf8_truncate(x: Column, limit: int) -> Column:
    """The longest prefix of at most `limit` bytes that ends on a character."""
    raw = x.cast("binary")
    cut = F.coalesce(*[F.try_validate_utf8(F.substring(raw, 1, limit - k).cast("string")) for k in range(min(4, limit + 1))], F.lit(""))
    return F.when(F.octet_length(raw) <= limit, x).otherwise(cut)


def drop_malformed(raw: Column) -> Column:
    """Bytes as text, without what isn't UTF-8."""
    text = raw.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit("")))


@F.arrow_udf(T.StringType())
def _nfkc(x: pa.Array) -> pa.Array:
    return pa.array([None if s is None else unicodedata.normalize("NFKC", s).lower() for s in x.to_pylist()], pa.string())


def normalize(x: Column) -> Column:
    """NFKC, then lower case. Texts whose characters are in NFKC stay on the native path; only the others go to Python."""
    stable = x.rlike(_STABLE)
    return F.when(stable, F.lower(x)).otherwise(_nfkc(F.when(stable, F.lit(None)).otherwise(x)))


def tokens(normalized: Column) -> Column:
    return F.regexp_extract_all(normalized, F.lit(_FAST_TOKEN), F.lit(0))


def language_list(languages: Column) -> Column:
    return F.filter(F.transform(F.split(languages, ","), lambda x: F.trim(x)), lambda x: x != "")


def accepts(languages: Column, wanted: list[str] | None) -> Column:
    """None accepts every page; a list accepts pages that name one of its codes; an empty list none."""
    if wanted is None:
        return F.lit(True)
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(language_list(languages), F.array(*[F.lit(x) for x in wanted])), F.lit(False))


def clean_keywords(raw: Column) -> Column:
    """Terms of an array of keyword lists: split, trimmed, of sensible length, each once, in order."""
    low, high = KEYWORD_LENGTHS
    pieces = F.flatten(F.transform(raw, lambda x: F.split(x, KEYWORD_SEPARATORS)))
    terms = F.transform(pieces, lambda x: F.regexp_replace(x, f"^{BLANKS}|{BLANKS}$", ""))
    return F.array_distinct(F.filter(terms, lambda x: F.length(x).between(low, high)))


def informative(finding: Column) -> Column:
    bare = F.btrim(finding, F.lit(FINDING_TRIM))
    return (F.length(bare) > 0) & ~F.lower(bare).isin(NO_FINDING)


def parse_date(value: Column) -> Column:
    return F.try_to_timestamp(F.substring(value, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz")


def parse_length(value: Column) -> Column:
    """Digits only; anything else is null."""
    return F.when(value.rlike("^[0-9]+$"), value.try_cast("bigint"))
