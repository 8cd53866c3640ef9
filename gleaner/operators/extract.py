"""Findings: pages to a language model, informative replies to a sink."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gleaner.config import Settings
from gleaner.functions.llm import LLMClient, message, prompt, request_body
from gleaner.functions.text import BLANKS, informative


def findings(pages: DataFrame, settings: Settings, client: LLMClient, system: str, instruction: str, render: Callable[[], Column] = prompt) -> DataFrame:
    """uri, score, finding of every page, best first within each of llm.parallel partitions; a failing call gives an empty finding."""
    asked = pages.select("uri", "score", F.concat(F.lit(instruction + "\n\n"), render()).alias("input"))
    asked = asked.repartition(settings.parallel).sortWithinPartitions("score", "uri")
    model, timeout, thinking = settings.llm["model"], settings.llm.get("timeout", 120), settings.llm.get("thinking", False)

    def run(frames):
        for frame in frames:
            said = []
            for text in frame["input"]:
                try:
                    said.append(message(client.send(request_body(model, system, text, thinking=thinking), timeout)))
                except Exception:  # noqa: BLE001  one page may not end the run
                    said.append("")
            yield pd.DataFrame({"uri": frame["uri"], "score": frame["score"], "finding": said})

    return asked.mapInPandas(run, "uri string, score double, finding string")


def observed(pages: DataFrame, name: str = "pages") -> tuple[DataFrame, Observation]:
    """The same pages, and what the first action on them tells by the way: how many, how good, which last. `name` is also what a
    streaming query's listener finds it by."""
    watch = Observation(name)
    return pages.observe(watch, F.count(F.lit(1)).alias("pages"), F.min("score").alias("least"), F.max("score").alias("most"), F.max("uri").alias("uri")), watch


def rate(pages: int, seconds: float) -> float:
    """Pages an hour."""
    return 3600 * pages / seconds if seconds > 0 else 0.0


def counters(found: DataFrame) -> DataFrame:
    """One row: pages seen, and findings that say anything."""
    return found.agg(F.count(F.lit(1)).alias("pages"), F.count_if(informative(F.col("finding"))).alias("written"))


def write_findings(found: DataFrame, path: str, mode: str = "overwrite") -> dict[str, int]:
    """Informative findings, trimmed, each followed by a blank line, best first. Returns pages seen and findings written."""
    found = found.persist()  # at most the shortlist's rows; the model is asked once a page
    try:
        kept = found.where(informative(F.col("finding"))).withColumn("value", F.concat(F.regexp_replace("finding", f"^{BLANKS}|{BLANKS}$", ""), F.lit("\n")))
        kept.orderBy("score", "uri").select("value").write.mode({"w": "overwrite", "a": "append"}.get(mode, mode)).text(path)
        return counters(found).first().asDict()
    finally:
        found.unpersist()
