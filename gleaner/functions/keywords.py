"""Keyword scoring: occurrences (or their weights) of many keywords in one native regex.

Keywords are factored into a trie whose forks are parted by the next character, so the regex engine takes about as long for
thousands of keywords as for ten, and optional continuations make matches leftmost-longest. Only A-Z is folded (the regex flag folds ASCII alone, so texts are
scanned as they are); there are no word boundaries.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.text import LOWER, UPPER, ascii_lower

_FOLD = str.maketrans(UPPER, LOWER)


def trie_regex(keywords: Sequence[str]) -> str:
    """A pattern for ASCII-lower-cased text that matches the longest keyword at the leftmost place."""
    root: dict = {}
    for word in keywords:
        node = root
        for char in word.translate(_FOLD):
            node = node.setdefault(char, {})
        node[""] = {}
    root.pop("", None)
    if not root:
        return "(?!)"
    return _branch(root)


def _quote(char: str) -> str:
    return "\\" + char if re.match(r"[\\^$.|?*+()\[\]{}&~#-]", char) else char


#: Arms that are tried one after the other; more are parted by a look at the next character.
ARMS = 4


def _parted(arms: list[tuple[str, str]]) -> str:
    """An alternation of (first character, arm): halves behind a look at the next character, so that a place costs the logarithm
    of the arms."""
    if len(arms) <= ARMS:
        return "|".join(arm for _, arm in arms)
    half = len(arms) // 2
    looks = lambda some: f"(?=[{''.join(_quote(char) for char, _ in some)}])(?:{_parted(some)})"
    return looks(arms[:half]) + "|" + looks(arms[half:])


def _branch(node: dict) -> str:
    ends = "" in node
    arms = []
    for first, child in sorted((c, n) for c, n in node.items() if c):
        chain = _quote(first)
        while len(child) == 1 and "" not in child:  # no group for a stretch without forks
            (char, child), = child.items()
            chain += _quote(char)
        arms.append((first, chain + (_branch(child) if set(child) != {""} else "")))
    body = arms[0][1] if len(arms) == 1 and not ends else "(?:" + _parted(arms) + ")"
    return body + "?" if ends else body


class KeywordMatcher:
    """Scores text by keyword: 1 an occurrence for a list, the keyword's weight for a mapping."""

    def __init__(self, keywords: Sequence[str] | Mapping[str, float]):
        self.weights = {k.translate(_FOLD): float(v) for k, v in keywords.items()} if isinstance(keywords, Mapping) else None
        self.keywords = [k.translate(_FOLD) for k in keywords if k]
        self.pattern = "(?i)" + trie_regex(self.keywords)

    def matches(self, content: Column) -> Column:
        return F.regexp_extract_all(content, F.lit(self.pattern), F.lit(0))

    def score(self, content: Column) -> Column:
        if self.weights is None:
            return F.regexp_count(content, F.lit(self.pattern)).cast("bigint")
        if not self.weights:
            return F.lit(0.0)
        weight = F.create_map(*[F.lit(x) for pair in self.weights.items() for x in pair])
        return F.aggregate(self.matches(content), F.lit(0.0), lambda total, m: total + F.coalesce(F.element_at(weight, ascii_lower(m)), F.lit(0.0)))
