"""The waterfall: keyword selection, deduplication, embedding selection."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.keywords import KeywordMatcher
from gleaner.functions.text import accepts
from gleaner.functions.vectors import Encoder, distance, embed, literal
from gleaner.operators.dedup import dedup, fifo_dedup
from gleaner.operators.topk import bounded_topk


class Selector(Protocol):
    """A strategy that keeps the best pages and scores them."""

    def apply(self, pages: DataFrame) -> DataFrame: ...


class KeywordSelector:
    """Pages with a score of at least min_matches; the `capacity` highest."""

    def __init__(self, matcher: KeywordMatcher, capacity: int, min_matches: float = 1):
        self.matcher, self.capacity, self.min_matches = matcher, capacity, min_matches

    def apply(self, pages: DataFrame) -> DataFrame:
        # The best come first, so the bound on them alone gives the same rows, and the score is worked out once.
        scored = pages.withColumn("score", self.matcher.score(F.col("content")).cast("double"))
        return bounded_topk(scored, "score", self.capacity, ascending=False).where(F.col("score") >= self.min_matches)


class EmbeddingSelector:
    """The `capacity` pages nearest to the query; a threshold on similarity is optional."""

    def __init__(self, query: str, encoder: Encoder, capacity: int, threshold: float | None = None):
        self.encoder, self.capacity, self.threshold = encoder, capacity, threshold
        self.vector = encoder.encode([query])[0]

    def apply(self, pages: DataFrame) -> DataFrame:
        scored = pages.withColumn("score", distance(literal(self.vector), embed(F.col("content"), self.encoder)))
        if self.threshold is not None:
            scored = scored.where(F.lit(1.0) - F.col("score") >= self.threshold)
        return bounded_topk(scored, "score", self.capacity)


def select(strategy: Selector, pages: DataFrame) -> DataFrame:
    return strategy.apply(pages)


def waterfall(pages: DataFrame, matcher: KeywordMatcher | None, query: str, encoder: Encoder, capacity: int, min_matches: float = 1, languages: list[str] | None = None, threshold: float | None = None, seen: int | None = None) -> DataFrame:
    """Cheapest filter first: language, keywords, fingerprint, distance. Without a matcher the keyword stage is skipped.

    Deduplication compares all pages with each other. With `seen`, the keyword stage's shortlist (at most `capacity` pages)
    goes through the sequential window of the last `seen` fingerprints instead, best first.
    """
    pages = pages.where(accepts(F.col("languages"), languages))
    if matcher is not None:
        pages = select(KeywordSelector(matcher, capacity, min_matches), pages)
    once = dedup(pages) if seen is None or matcher is None else fifo_dedup(pages, [F.desc("score"), F.asc("uri")], seen)
    return select(EmbeddingSelector(query, encoder, capacity, threshold), once)
