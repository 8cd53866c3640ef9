"""Everything that goes over HTTP, against a server of this process."""

import gzip
import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from gleaner.config import Settings
from gleaner.functions.llm import client_of
from gleaner.functions.vectors import HashEncoder, relevant_text
from gleaner.operators.extract import findings, observed, rate, write_findings
from gleaner.plans.research import research
from gleaner.sources.tables import fetch_text, query_text, seed, seed_text
from gleaner.sources.wet import read_stored, read_wet, resolve
from tests.test_wet import record


@pytest.fixture(scope="module")
def server():
    archive = gzip.compress(record("http://a/one", "harbour lights at dusk", "eng") + record("http://a/two", "nichts davon", "deu"))
    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def log_message(self, *args):
            pass

        def answer(self, code, body):
            self.send_response(code)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            pages = {"/one.wet.gz": archive, "/wet.paths.gz": gzip.compress(b"one.wet.gz\none.wet.gz\n"), "/page": "<p>Sea &amp; <b>shore</b></p>".encode(), "/blank": b"<p> </p>"}
            self.answer(200, pages[self.path]) if self.path in pages else self.answer(404, b"none")

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, self.headers["Authorization"], body))
            if self.path == "/fails":
                self.answer(500, b"failure")
            else:
                self.answer(200, json.dumps({"choices": [{"message": {"content": "seen: " + body["messages"][1]["content"][-5:]}}]}).encode())

    made = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}", asked
    made.shutdown()


def test_archives_and_index(spark, server):
    base, _ = server
    got = read_wet(spark, f"{base}/one.wet.gz", languages=["eng"]).collect()
    assert [(r.uri, r.content, r.languages) for r in got] == [("http://a/one", "harbour lights at dusk", "eng")]
    assert resolve(f"{base}/wet.paths.gz", f"{base}/") == [f"{base}/one.wet.gz"] * 2
    listed = read_wet(spark, f"{base}/wet.paths.gz", root=f"{base}/")
    assert listed.count() == 4 and listed.rdd.getNumPartitions() == 2


def test_archives_in_a_store(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.warc.wet.gz").write_bytes(gzip.compress(record(name, "text", "eng")) + gzip.compress(record(name, "skip", "rus")))
    (tmp_path / "readme.txt").write_text("no archive")
    assert sorted((r.uri, r.content) for r in read_stored(spark, f"file://{tmp_path}", languages=["eng"]).collect()) == [("a", "text"), ("b", "text")]


def test_pages(spark, server):
    base, _ = server
    assert fetch_text(spark, f"{base}/page") == "Sea & shore" and query_text(spark, f"{base}/page") == "Sea & shore" and query_text(spark, "plain words") == "plain words"
    assert seed(spark, [f"{base}/page", f"{base}/blank"]) == "Sea & shore"
    told = []
    assert seed_text(spark, [f"{base}/missing", f"{base}/page"], warn=told.append) == "Sea & shore" and "/missing" in told[0]
    with pytest.raises(OSError):
        seed(spark, [f"{base}/missing"])


def settings(base, path, tmp_path, **pipeline):
    return Settings(
        crawl={"languages": ["eng"], "path": f"{base}/one.wet.gz"},
        pipeline={"seeds": [f"{base}/page"], "keywords": [f"word{i}" for i in range(10)] + ["harbour"]} | pipeline,
        llm={"model": "m", "baseurl": base, "path": path, "password": "pw", "parallel": 1, "timeout": 10},
        output={"path": str(tmp_path / "report")},
        prompts={"system": "s", "input": "i"},
    )


def report(tmp_path):
    return "".join(p.read_text() for p in sorted((tmp_path / "report").glob("part-*")))


def test_requests(spark, server, tmp_path):
    base, asked = server
    df = spark.createDataFrame([("u", "eng", 0.5, "body")], "uri string, languages string, score double, content string")
    s = settings(base, "/chat", tmp_path)
    assert write_findings(findings(df, s, client_of(s), "s", "i", lambda: F.col("content")), s.output["path"]) == {"pages": 1, "written": 1}
    path, bearer, body = asked[-1]
    assert (path, bearer, body["model"]) == ("/chat", "Bearer pw", "m") and body["messages"][1]["content"] == "i\n\nbody"
    assert report(tmp_path) == "seen: \nbody\n\n"


def test_server_errors_give_an_empty_report(spark, server, tmp_path):
    base, _ = server
    df = spark.createDataFrame([("u", "eng", 0.5, "body")], "uri string, languages string, score double, content string")
    s = settings(base, "/fails", tmp_path)
    assert write_findings(findings(df, s, client_of(s), "s", "i"), s.output["path"]) == {"pages": 1, "written": 0}
    assert report(tmp_path) == ""


def test_research_over_http(spark, server, tmp_path):
    base, _ = server
    told = research(spark, settings(base, "/chat", tmp_path, dedupe_capacity=10), client_of(settings(base, "/chat", tmp_path)), HashEncoder())
    assert told == {"pages": 1, "written": 1} and report(tmp_path).startswith("seen: ")


def test_observed(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "uri string, score double")
    pages, watch = observed(df)
    pages.write.format("noop").mode("overwrite").save()
    assert watch.get == {"pages": 2, "least": 1.0, "most": 3.0, "uri": "b"} and rate(2, 60.0) == 120.0


def test_relevant_text(spark):
    df = spark.createDataFrame([("sea shore",), ("sand dune",), (None,)], "x string")
    assert [r.y for r in df.select(relevant_text("shore sea", F.col("x"), HashEncoder()).alias("y")).collect()] == [True, False, False]
