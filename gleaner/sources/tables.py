"""Pages out of stored tables, and text out of web pages."""

from __future__ import annotations

import urllib.request
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.text import html_plaintext, utf8_truncate
from gleaner.schema import CONTENT_BYTES, unscored

# ISO 639-1 codes of the tables as ISO 639-3.
CODES = {"en": "eng", "fr": "fra", "de": "deu", "es": "spa"}
EPOCH = "2026-01-01 00:00:00"


def _codes(lang):
    names = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    return F.coalesce(F.element_at(names, lang), lang, F.lit(""))


def document_pages(documents: DataFrame) -> DataFrame:
    """documents as pages, with their id."""
    return documents.select("doc_id", F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("uri"), utf8_truncate(F.col("text"), CONTENT_BYTES).alias("content"), _codes(F.col("lang")).alias("languages"), F.lit(EPOCH).cast("timestamp_ntz").alias("date"), F.octet_length("text").cast("bigint").alias("length"), unscored().alias("score"))


def web_pages(pages: DataFrame) -> DataFrame:
    """pages (url, html) as pages of plain text, with their id."""
    lang = F.regexp_extract("html", r'(?i)<html[^>]*\blang="([^"]*)"', 1)
    return pages.select("page_id", F.col("url").alias("uri"), utf8_truncate(html_plaintext(F.col("html")), CONTENT_BYTES).alias("content"), _codes(lang).alias("languages"), F.lit(EPOCH).cast("timestamp_ntz").alias("date"), F.octet_length("html").cast("bigint").alias("length"), unscored().alias("score"))


def seed_parts(pages: DataFrame, key: str) -> DataFrame:
    """key, part: what each page adds to the joined text, blank ones left out; no row gathers the text."""
    texts = pages.select(key, html_plaintext(F.col("html")).alias("part")).where("part <> ''")
    last = texts.agg(F.max(key)).first()[0]
    return texts.select(key, F.concat("part", F.when(F.col(key) == last, F.lit("")).otherwise(F.lit("\n\n"))).alias("part"))


Fetch = Callable[[str], str]


def http_fetch(url: str) -> str:
    with urllib.request.urlopen(url, timeout=30) as reply:  # noqa: S310
        return reply.read().decode("utf-8", "ignore")


def fetch_text(spark: SparkSession, url: str, fetch: Fetch = http_fetch) -> str:
    """A page's plain text, by the same expression as tables use."""
    return spark.range(1).select(html_plaintext(F.lit(fetch(url))).alias("t")).first().t


def query_text(spark: SparkSession, query: str, fetch: Fetch = http_fetch) -> str:
    """A query as it is, or the text of the page that it names."""
    return fetch_text(spark, query, fetch) if query.startswith(("http://", "https://")) else query


def seed(spark: SparkSession, urls: Sequence[str], fetch: Fetch = http_fetch) -> str:
    """The pages' texts, blank ones left out, with blank lines between; a failing page raises."""
    return "\n\n".join(t for t in (fetch_text(spark, u, fetch) for u in urls) if t)


def seed_text(spark: SparkSession, urls: Sequence[str], fetch: Fetch = http_fetch, warn: Callable[[str], None] = print) -> str:
    """seed, but a failing page is reported and left out."""
    texts = []
    for url in urls:
        try:
            texts.append(fetch_text(spark, url, fetch))
        except Exception as problem:  # noqa: BLE001
            warn(f"seed page {url} skipped: {type(problem).__name__}")
    return "\n\n".join(t for t in texts if t)
