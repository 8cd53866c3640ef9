import gzip
import json

import pytest
from pyspark.sql import functions as F

from gleaner.config import Settings, load_settings
from gleaner.functions.llm import extract_keywords, local_prompt, message, prompt, request_body, summarize, target_languages
from gleaner.functions.vectors import HashEncoder
from gleaner.operators.extract import findings, write_findings
from gleaner.plans.research import bootstrap, language_keywords, research, research_local
from gleaner.sources.tables import seed, seed_text
from tests.test_wet import record


class Canned:
    """Answers with a fixed text, or fails on inputs that hold a word."""

    def __init__(self, text, fail_on="\0"):
        self.text, self.fail_on = text, fail_on

    def send(self, body, timeout):
        if self.fail_on in body["messages"][1]["content"]:
            raise RuntimeError("500")
        return {"choices": [{"message": {"content": self.text}}]}


def settings(tmp_path, **pipeline):
    return Settings(
        crawl={"languages": ["eng"], "path": str(tmp_path / "pages.wet.gz")},
        pipeline={"capacity": 10, "seeds": ["u"]} | pipeline,
        llm={"model": "m", "baseurl": "http://none", "path": "/", "parallel": 2},
        output={"path": str(tmp_path / "report")},
        prompts={"system": "s", "input": "i", "local_system": "s", "local_input": "i", "keywords_system": "k", "summary_system": "z"},
    )


def report(tmp_path):
    return "".join(p.read_text() for p in sorted((tmp_path / "report").glob("part-*")))


def test_request_and_reply(tmp_path):
    body = request_body("m", "s", "t", temperature=0.2)
    assert body["messages"][1] == {"role": "user", "content": "t"} and body["temperature"] == 0.2 and body["enable_thinking"] is False and "max_tokens" not in body
    assert "enable_thinking" not in request_body("m", "s", "t", thinking=True)
    assert message({"choices": [{"message": {"content": " ", "reasoning_content": "r"}}]}) == "r"
    assert extract_keywords(settings(tmp_path), Canned('{"keywords":["ebb","tide"]}'), "text", ["eng"]) == ["ebb", "tide"]
    assert summarize(settings(tmp_path), Canned("short"), "text") == "short"
    assert target_languages(["deu", "fra", "qqq"]) == "German, French, qqq"


def test_prompts(spark):
    df = spark.createDataFrame([("u", "fra,deu", 0.25, "é" * 5000)], "uri string, languages string, score double, content string")
    row = df.select(prompt().alias("a"), local_prompt().alias("b")).first()
    assert row.a == "URI: u\nLANGUAGE: fra,deu\nSCORE: 0.25\n\n" + "é" * 3000
    assert row.b.startswith("SOURCE URL: u\nLANGUAGE: fra,deu\nDISTANCE: 0.25\n\nPAGE EXCERPT:\né")


def test_settings_file(tmp_path):
    (tmp_path / "s.toml").write_text('[crawl]\nlanguages=["eng"]\n[pipeline]\ncapacity=5\nmin_keywords=4\n')
    read = load_settings(str(tmp_path / "s.toml"))
    assert (read.languages, read.capacity, read.min_keywords, read.dedupe_capacity, read.threshold) == (["eng"], 5, 4, 100_000, None)


def test_keyword_sources(spark, tmp_path):
    cache = tmp_path / "cache.json"
    cache.write_text(json.dumps({"fra": ["marée"], "eng": ["old"]}))
    s = settings(tmp_path, keyword_cache=str(cache))
    s.crawl.update(languages=["eng", "fra", "deu"], manual_keywords={"eng": ["tide"]})
    assert language_keywords(spark, s, "text", Canned('{"keywords":["ebbe, tide"]}')) == ["tide", "marée", "ebbe"]
    assert json.loads(cache.read_text())["deu"] == ["ebbe", "tide"]


def test_bootstrap_guards(spark, tmp_path):
    s = settings(tmp_path, keywords=[f"word{i}" for i in range(12)])
    matcher, query = bootstrap(spark, s, Canned(""), lambda u: "<p>text</p>")
    assert len(matcher.keywords) == 12 and query.startswith("word0 word1")
    for bad, fetch in ((settings(tmp_path, seeds=[]), str), (settings(tmp_path), lambda u: "<p> </p>"), (settings(tmp_path, keywords=["few"]), lambda u: "text")):
        with pytest.raises(ValueError):
            bootstrap(spark, bad, Canned(""), fetch)


def test_seeds(spark):
    def fetch(u):
        if u == "bad":
            raise OSError("no")
        return f"<p>{u}</p>"

    assert seed_text(spark, ["a", "bad", "b"], fetch, lambda w: None) == "a\n\nb"
    with pytest.raises(OSError):
        seed(spark, ["bad"], fetch)


def test_research_end_to_end(spark, tmp_path):
    (tmp_path / "pages.wet.gz").write_bytes(gzip.compress(record("coast", "word1 word2 lighthouse") + record("inland", "wheat fields") + record("fail", "word1 word3 broken")))
    s = settings(tmp_path, keywords=[f"word{i}" for i in range(12)])
    told = research(spark, s, Canned(" found it \n", fail_on="broken"), HashEncoder(), lambda u: "text")
    assert told == {"pages": 2, "written": 1} and report(tmp_path) == "found it\n\n"


def test_local_research(spark, tmp_path):
    (tmp_path / "pages.wet.gz").write_bytes(gzip.compress(record("none", "Wheat and barley fields.")))
    told = research_local(spark, settings(tmp_path), Canned("x"), HashEncoder(), ["u"], str(tmp_path / "pages.wet.gz"), lambda u: "lighthouse")
    assert told["written"] == 0 and report(tmp_path) == ""


def test_append_mode(spark, tmp_path):
    df = spark.createDataFrame([("u", "eng", 0.1, "text")], "uri string, languages string, score double, content string")
    s = settings(tmp_path)
    for mode in ("w", "a"):
        write_findings(findings(df, s, Canned("one"), "s", "i", lambda: F.col("content")), s.output["path"], mode)
    assert report(tmp_path) == "one\n\none\n\n"
