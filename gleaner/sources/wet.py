"""A Python data source for WET archives: `spark.read.format("wet").load(path)`.

One partition is one gzip file, local or by HTTP. Records are framed by their length, so a body may hold what looks
like a header; a record whose language isn't wanted is skipped before its body is kept.
"""

from __future__ import annotations

import gzip
import io
import itertools
import os
import re
import urllib.request
from collections.abc import Callable, Iterator
from datetime import datetime
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gleaner.schema import CONTENT_BYTES, LANGUAGE_BYTES, PAGE_SCHEMA, UNSCORED, URI_BYTES

# The record's first line, and the header fields that are read.
MAGIC = b"WARC/1.0"
FIELDS = {b"WARC-Type:": "kind", b"WARC-Target-URI:": "uri", b"WARC-Date:": "date", b"WARC-Identified-Content-Language:": "languages", b"Content-Length:": "length"}


def truncated(raw: bytes, limit: int) -> bytes:
    """At most `limit` bytes, cut before a character that doesn't fit; malformed bytes are left alone."""
    if len(raw) <= limit:
        return raw
    raw = raw[:limit]
    for back in range(1, min(4, len(raw)) + 1):
        lead = raw[-back]
        if lead & 0xC0 != 0x80:
            need = 1 if lead < 0x80 else 2 if lead >> 5 == 6 else 3 if lead >> 4 == 14 else 4 if lead >> 3 == 30 else 1
            return raw[:-back] if need > back else raw
    return raw


def wanted_language(listed: str | None, wanted: list[str] | None) -> bool:
    if wanted is None:
        return True
    return listed is not None and any(x.strip() in wanted for x in listed.split(","))


def _header(stream: BinaryIO, languages: list[str] | None) -> dict[str, str | int | bool]:
    """The fields up to the blank line: the first value of each; of lengths the first that isn't 0, and of language lines
    the first that is wanted; whether any type line says conversion. `body` is how far the record goes: an unreadable
    length counts by its leading digits there, though such a record isn't kept."""
    out: dict[str, str | int | bool] = {"length": 0, "body": 0, "conversion": False, "wanted": languages is None}
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            break
        for name, key in FIELDS.items():
            if not line.startswith(name):
                continue
            value = line[len(name) :].rstrip(b"\n").removesuffix(b"\r").lstrip(b" \t").decode("utf-8", "ignore")
            if key == "kind":
                out["conversion"] |= value == "conversion"
            elif key == "length":
                out["body"] = out["body"] or int(re.match("[0-9]*", value)[0] or 0)
                out["length"] = out["length"] or (int(value) if re.fullmatch("[0-9]+", value) else 0)
            elif key != "languages":
                out.setdefault(key, value)
            elif key not in out and wanted_language(value, languages):
                out[key], out["wanted"] = value, True
    return out


def _skip(stream: BinaryIO, n: int) -> None:
    while n > 0 and (got := stream.read(min(n, 1 << 16))):
        n -= len(got)


def records(stream: BinaryIO, languages: list[str] | None = None, content_bytes: int = CONTENT_BYTES) -> Iterator[tuple]:
    """(uri, content, languages, date, length, score) of the stream's conversion records."""
    while line := stream.readline():
        if not line.startswith(MAGIC):
            continue
        head = _header(stream, languages)
        length = head["length"]
        try:
            date = datetime.strptime(head.get("date", "")[:19], "%Y-%m-%dT%H:%M:%S")
        except ValueError:
            date = None
        keep = head["conversion"] and head.get("uri") and date and length and head["wanted"]
        if not keep:
            _skip(stream, head["body"])
            continue
        body = stream.read(min(length, content_bytes + 4))
        if len(body) < min(length, content_bytes + 4):
            continue  # cut off: no record
        _skip(stream, length - len(body))
        cut = lambda x, n: truncated(x.encode(), n).decode("utf-8", "ignore")
        yield cut(head["uri"], URI_BYTES), truncated(body, content_bytes).decode("utf-8", "ignore"), cut(head.get("languages", ""), LANGUAGE_BYTES), date, length, UNSCORED


#: Records handed over at once: some MB at most, as contents are bounded.
BATCH_RECORDS = 512
_ARROW = pa.schema([("uri", pa.string()), ("content", pa.string()), ("languages", pa.string()), ("date", pa.timestamp("us")), ("length", pa.int64()), ("score", pa.float64())])


def record_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Pages by the batch."""
    while some := list(itertools.islice(rows, BATCH_RECORDS)):
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*some), _ARROW)], schema=_ARROW)


def open_path(path: str) -> BinaryIO:
    if path.startswith(("http://", "https://")):
        return urllib.request.urlopen(path, timeout=30)  # noqa: S310
    return open(path.removeprefix("file://"), "rb")


class WetPartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WetReader(DataSourceReader):
    def __init__(self, options: dict, opener: Callable[[str], BinaryIO] = open_path):
        listed = options.get("languages")
        self.languages = None if listed is None else [x.strip() for x in listed.split(",") if x.strip()]
        self.content_bytes = int(options.get("contentbytes", options.get("contentBytes", CONTENT_BYTES)))
        self.opener = opener
        self.paths = resolve(options["path"], options.get("root", ""), opener)

    def partitions(self) -> list[InputPartition]:
        return [WetPartition(p) for p in self.paths]

    def read(self, partition: WetPartition) -> Iterator[pa.RecordBatch]:
        with self.opener(partition.path) as raw, gzip.open(raw) as stream:
            yield from record_batches(records(stream, self.languages, self.content_bytes))


class WetDataSource(DataSource):
    """Options: path (a file, a folder, a URL, or an index ending in paths.gz), root (put before an index's lines), languages, contentBytes."""

    @classmethod
    def name(cls) -> str:
        return "wet"

    def schema(self):
        return PAGE_SCHEMA

    def reader(self, schema):
        return WetReader(self.options)


def wet_paths(stream: BinaryIO) -> list[str]:
    """The index's newline-terminated lines, as they are."""
    with gzip.open(stream) as text:
        return [line[:-1].decode() for line in text if line.endswith(b"\n")]


def resolve(path: str, root: str = "", opener: Callable[[str], BinaryIO] = open_path) -> list[str]:
    """The files behind a path. A local file is itself; an index lists files under root; a name that's no file is put after root."""
    local = path.removeprefix("file://")
    if path.endswith("paths.gz"):
        with opener(path) as index:
            return [root + line for line in wet_paths(index)]
    if os.path.isdir(local):
        return sorted(os.path.join(local, x) for x in os.listdir(local) if x.endswith(".gz"))
    if os.path.isfile(local) or path.startswith("http"):
        return [path]
    return [root + path]


def read_wet(spark: SparkSession, path: str, root: str = "", languages: list[str] | None = None) -> DataFrame:
    spark.dataSource.register(WetDataSource)
    reader = spark.read.format("wet").option("root", root)
    if languages is not None:
        reader = reader.option("languages", ",".join(languages))
    return reader.load(path)


def read_stored(spark: SparkSession, path: str, languages: list[str] | None = None, content_bytes: int = CONTENT_BYTES) -> DataFrame:
    """Archives in any store that Spark reads: each file comes to a task as bytes, and its records leave it by the batch."""

    def run(batches):
        for batch in batches:
            for file in batch.column(0):
                with gzip.open(io.BytesIO(file.as_py())) as stream:
                    yield from record_batches(records(stream, languages, content_bytes))

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content").mapInArrow(run, PAGE_SCHEMA)


def read_paths(spark: SparkSession, path: str) -> DataFrame:
    """An index as a table of paths."""
    return spark.read.text(path).withColumnRenamed("value", "path")
