"""From settings to a report: keywords, query, waterfall, findings."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.config import Settings
from gleaner.functions.keywords import KeywordMatcher
from gleaner.functions.llm import LLMClient, extract_keywords, local_prompt, prompt
from gleaner.functions.text import clean_keywords
from gleaner.functions.vectors import Encoder
from gleaner.operators.counts import term_weights
from gleaner.operators.extract import findings, write_findings
from gleaner.operators.select import waterfall
from gleaner.sources.tables import Fetch, http_fetch, seed, seed_text
from gleaner.sources.wet import read_wet

LEAST_KEYWORDS = 10


def first_of(*sources: Column) -> Column:
    """Maps of terms by language as one map: a language has the terms of the first source with any; an empty list is none."""
    some = lambda terms: F.when(F.size(terms) > 0, terms)
    return reduce(lambda a, b: F.map_zip_with(a, b, lambda _, x, y: F.coalesce(some(x), some(y))), sources)


def joined_terms(by_language: Column) -> Column:
    """The terms of all languages in the order of their codes."""
    return F.flatten(F.transform(F.filter(F.array_sort(F.map_entries(by_language)), lambda e: e["value"].isNotNull()), lambda e: e["value"]))


def cleaned(spark: SparkSession, raw: list[str]) -> list[str]:
    return spark.range(1).select(clean_keywords(F.lit(raw) if raw else F.array().cast("array<string>")).alias("k")).first().k


def language_keywords(spark: SparkSession, settings: Settings, article: str, client: LLMClient) -> list[str]:
    """Each language's terms from the first source that has any: manual, cache, the model; new ones go to the cache."""
    manual, path = settings.crawl.get("manual_keywords", {}), settings.pipeline.get("keyword_cache", "")
    cache: dict[str, list[str]] = {}
    if path and os.path.isfile(path):
        with open(path, encoding="utf-8") as f:
            cache = json.load(f)
    known = {lang: manual.get(lang) or cache.get(lang) for lang in settings.languages}
    missing = [lang for lang, terms in known.items() if not terms]
    if missing:
        ask = lambda lang: extract_keywords(settings, client, article, [lang], limit=6000, timeout=900)
        with ThreadPoolExecutor(max(1, settings.llm.get("parallel", 1))) as pool:
            made = {lang: cleaned(spark, terms) for lang, terms in zip(missing, pool.map(ask, missing))}
        known |= made
        if path:
            with open(path, "w", encoding="utf-8") as f:
                json.dump(cache | made, f, ensure_ascii=False)
    return cleaned(spark, [term for lang in settings.languages for term in known.get(lang) or []])


def bootstrap(spark: SparkSession, settings: Settings, client: LLMClient, fetch: Fetch = http_fetch) -> tuple[KeywordMatcher, str]:
    """(matcher, query text). The query is the keywords themselves, not the seed pages' text."""
    seeds = settings.pipeline.get("seeds", [])
    if not seeds:
        raise ValueError("pipeline.seeds names no page")
    article = seed_text(spark, seeds, fetch)
    if not article.strip():
        raise ValueError("every seed page is empty")
    listed = settings.pipeline.get("keywords", [])
    keywords = cleaned(spark, list(listed)) if listed else language_keywords(spark, settings, article, client)
    if len(keywords) < LEAST_KEYWORDS:
        raise ValueError(f"only {len(keywords)} keywords; at least {LEAST_KEYWORDS} are needed")
    return KeywordMatcher(keywords), " ".join(keywords)


def research(spark: SparkSession, settings: Settings, client: LLMClient, encoder: Encoder, fetch: Fetch = http_fetch, pages: DataFrame | None = None) -> dict[str, int]:
    """The configured crawl to the configured output."""
    matcher, query = bootstrap(spark, settings, client, fetch)
    if pages is None:
        pages = read_wet(spark, settings.crawl["path"], settings.crawl.get("root", ""), settings.languages)
    best = waterfall(pages, matcher, query, encoder, settings.capacity, settings.min_keywords, threshold=settings.threshold, seen=settings.dedupe_capacity)
    return _report(best, settings, client, "system", "input", prompt)


def research_local(spark: SparkSession, settings: Settings, client: LLMClient, encoder: Encoder, urls: list[str], path: str, fetch: Fetch = http_fetch) -> dict[str, int]:
    """One archive, with weights of the seed pages' own terms and their first 2000 characters as the query."""
    article = seed(spark, urls, fetch)
    terms = term_weights(spark.range(1).select(F.lit(article).alias("t")), F.col("t")).collect()
    matcher = KeywordMatcher({r.token: r.weight for r in terms})
    best = waterfall(read_wet(spark, path, languages=settings.languages), matcher, article[:2000], encoder, settings.capacity)
    return _report(best, settings, client, "local_system", "local_input", local_prompt)


def _report(best: DataFrame, settings: Settings, client: LLMClient, system: str, instruction: str, render: Callable) -> dict[str, int]:
    # The shortlist has at most `capacity` rows; kept, so that the model is asked once a page.
    best = best.persist()
    try:
        return write_findings(findings(best, settings, client, settings.prompts[system], settings.prompts[instruction], render), settings.output["path"], "w")
    finally:
        best.unpersist()
