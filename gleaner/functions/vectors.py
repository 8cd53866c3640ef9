"""Distances of unit vectors, and encoders that turn text into such vectors."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RELEVANT = 0.6


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def distance(query: Column, vector: Column) -> Column:
    """1 - dot product, in double precision; both sides are unit vectors."""
    return F.lit(1.0) - dot(query, vector)


def similarity(query: Column, vector: Column) -> Column:
    return F.lit(1.0) - distance(query, vector)


def is_relevant(query: Column, vector: Column, threshold: float = RELEVANT) -> Column:
    return similarity(query, vector) >= threshold


def relevant_text(query: str, text: Column, encoder: Encoder, threshold: float = RELEVANT) -> Column:
    """is_relevant of a text column and a query text."""
    return is_relevant(literal(encoder.encode([query])[0]), embed(text, encoder), threshold)


def literal(vector: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in vector])


class Encoder(Protocol):
    """Anything that maps texts to unit vectors; must pickle."""

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashEncoder:
    """A deterministic stand-in for a static embedding model: bit d of MD5(token) votes on dimension d."""

    def __init__(self, dims: int = 64):
        self.dims = dims

    def _token(self, token: str) -> np.ndarray:
        bits = np.unpackbits(np.frombuffer(hashlib.md5(token.encode()).digest(), dtype=np.uint8))
        return np.resize(bits, self.dims).astype(np.float64) * 2 - 1

    def encode(self, texts: list[str]) -> np.ndarray:
        import regex

        find = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]|[\p{L}\p{N}]+").findall
        known: dict[str, np.ndarray] = {}
        out = np.zeros((len(texts), self.dims))
        for i, text in enumerate(texts):
            for token in find((text or "").lower()):
                if token not in known:
                    known[token] = self._token(token)
                out[i] += known[token]
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norm, out=out, where=norm > 0)


class VectorTableEncoder:
    """Mean of token vectors from a local snapshot: `vectors.npy` beside `tokens.txt`. Nothing is ever downloaded."""

    def __init__(self, path: str):
        if not os.path.isdir(path):
            raise FileNotFoundError(f"no local model folder {path}")
        self.path = path

    def _load(self):
        if not hasattr(self, "_table"):
            with open(os.path.join(self.path, "tokens.txt"), encoding="utf-8") as f:
                self._index = {t.rstrip("\n"): i for i, t in enumerate(f)}
            self._table = np.load(os.path.join(self.path, "vectors.npy"), mmap_mode="r")
        return self._index, self._table

    def __getstate__(self):
        return {"path": self.path}

    def encode(self, texts: list[str]) -> np.ndarray:
        index, table = self._load()
        out = np.zeros((len(texts), table.shape[1]))
        for i, text in enumerate(texts):
            rows = [index[t] for t in (text or "").lower().split() if t in index]
            if rows:
                out[i] = table[rows].mean(axis=0)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norm, out=out, where=norm > 0)


#: Where model files lie that were fetched before, by the layout of the public hub's own client.
HUB_CACHE = os.path.join("~", ".cache", "huggingface", "hub")
# Number formats of a tensor file.
TENSOR_KINDS = {"F64": "<f8", "F32": "<f4", "F16": "<f2"}


def snapshot_dir(name: str, cache: str = HUB_CACHE) -> str:
    """A model folder: `name` itself, or the first snapshot of `organisation/model` in the local cache. Nothing is downloaded."""
    if os.path.isdir(name):
        return name
    base = os.path.join(os.path.expanduser(cache), "models--" + name.replace("/", "--"), "snapshots")
    found = sorted(os.listdir(base)) if os.path.isdir(base) else []
    if not found:
        raise FileNotFoundError(f"no local model {name}: {base} has no snapshot")
    return os.path.join(base, found[0])


def read_tensor(path: str, name: str) -> np.ndarray:
    """One tensor of a safetensors file: a length, a JSON header of that length, and raw numbers."""
    with open(path, "rb") as f:
        size = int.from_bytes(f.read(8), "little")
        facts = json.loads(f.read(size))[name]
    low, high = facts["data_offsets"]
    kind = np.dtype(TENSOR_KINDS[facts["dtype"]])
    return np.memmap(path, kind, "r", 8 + size + low, ((high - low) // kind.itemsize,)).reshape(facts["shape"])


class SnapshotEncoder:
    """A static embedding model from a local snapshot (config.json, tokenizer.json, model.safetensors): unit mean of token vectors."""

    def __init__(self, name: str, cache: str = HUB_CACHE):
        self.path = snapshot_dir(name, cache)
        with open(os.path.join(self.path, "config.json"), encoding="utf-8") as f:
            if not json.load(f).get("normalize"):
                raise ValueError(f"{name} makes no unit vectors, which distances here assume")

    def __getstate__(self):
        return {"path": self.path}

    def _load(self):
        if not hasattr(self, "_tokenizer"):
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(os.path.join(self.path, "tokenizer.json"))
            self._vectors = read_tensor(os.path.join(self.path, "model.safetensors"), "embeddings")
            with open(os.path.join(self.path, "tokenizer.json"), encoding="utf-8") as f:
                model = json.load(f)["model"]
            unknown = model.get("unk_token")
            self._unknown = self._tokenizer.token_to_id(unknown) if unknown else model.get("unk_id")
        return self._tokenizer, self._vectors, self._unknown

    def encode(self, texts: list[str]) -> np.ndarray:
        tokenizer, vectors, unknown = self._load()
        out = np.zeros((len(texts), vectors.shape[1]))
        for i, e in enumerate(tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)):
            ids = [t for t in e.ids if t != unknown]
            if ids:
                out[i] = vectors[ids].mean(axis=0, dtype=np.float64)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norm, out=out, where=norm > 0)


def embed(text: Column, encoder: Encoder) -> Column:
    """The encoder's vectors, a batch at a time; the encoder loads once in each worker."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(x: pa.Array) -> pa.Array:
        vectors = np.ascontiguousarray(encoder.encode(x.to_pylist()), dtype=np.float64)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]), pa.array(vectors.ravel()))

    return run(text)
