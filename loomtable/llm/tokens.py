"""Encoding and decoding of a corpus with a public byte-level BPE vocabulary.

Ids form a monoid over text: a text is halved until its parts are small, all parts of a batch
are encoded together, and neighbours are joined up the tree. At a join only a window around
the seam is encoded again. It grows to both sides, doubling, until it ends at places where
the pre-tokenizer must cut whatever stands beyond: between two neighbours of which the first
is no blank and which no pre-token can span (letter | digit | other sign | blank). Merges never
leave a pre-token, and each pre-token depends on nothing but itself and one character after
blanks, so the tokens outside such a window are proven to stay. A window that finds no such
place takes in the whole part. Decoding concatenates bytes.

Null and empty texts have no ids (an empty array). Special tokens are ordinary text. Texts
are encoded whole, however long; cost grows with n log n, and no step is quadratic in the
number of parts. One pass over the rows, no shuffle.
"""

from __future__ import annotations

import base64
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-tokenizer's pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF_CHARS = 1024
FIRST_WINDOW = 16


class Vocabulary:
    """A vocabulary file of ranks, ready to encode."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("loomtable", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes[rank] = token
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.encoding.encode_ordinary_batch(texts, num_threads=1)]

    def decode(self, ids) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8")


@lru_cache(4)
def vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """The vocabulary of a file; where a worker has no such path, of the copy that ship() sent it."""
    return Vocabulary(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))


def ship(spark: SparkSession, path: str) -> None:
    """Sends the driver's vocabulary file to the workers of the session, once per context."""
    context = spark.sparkContext
    sent = getattr(context, "_loomtable_files", set())
    if path not in sent and os.path.exists(path):
        context.addFile(path)
        context._loomtable_files = sent | {path}


@lru_cache(65536)
def _class(ch: str) -> str:
    """'L', 'N', 'O' or ' ' as the pre-tokenizer sees it, '?' where Unicode versions may differ."""
    category = unicodedata.category(ch)
    if ch in "\t\n\x0b\x0c\r \x85\xa0" or category in ("Zs", "Zl", "Zp"):
        return " "
    if category == "Cn":
        return "?"
    return category[0] if category[0] in "LN" else "O"


def must_cut(a: str, b: str) -> bool:
    """Whether a pre-token ends between a and b in any text that holds them side by side."""
    x, y = _class(a), _class(b)
    if "?" in (x, y) or x == " " or x == y:
        return False
    return not (x == "O" and a == "'")  # it may begin a contraction


def _last_cut(text: str) -> int:
    """The last sure cut strictly inside text, searched in growing windows from its end; 0 if none."""
    low, high = max(1, len(text) - FIRST_WINDOW), len(text)
    while True:
        for p in range(high - 1, low - 1, -1):
            if must_cut(text[p - 1], text[p]):
                return p
        if low == 1:
            return 0
        low, high = max(1, len(text) - 2 * (len(text) - low)), low


def _first_cut(text: str) -> int:
    """The first sure cut strictly inside text; its length if none."""
    low, high = 1, min(len(text), FIRST_WINDOW)
    while True:
        for p in range(low, high):
            if must_cut(text[p - 1], text[p]):
                return p
        if high == len(text):
            return len(text)
        low, high = high, min(len(text), 2 * high)


def join(v: Vocabulary, left: tuple[str, np.ndarray], right: tuple[str, np.ndarray]) -> tuple[str, np.ndarray]:
    """Ids of the joined text from those of its halves, encoding only the window at the seam."""
    (a, ids_a), (b, ids_b) = left, right
    if not a or not b:
        return (b, ids_b) if not a else (a, ids_a)
    i, j = _last_cut(a), _first_cut(b)
    tail, head = len(a[i:].encode()), len(b[:j].encode())
    back = np.cumsum(v.sizes[ids_a[: -tail - 1 : -1]])  # a token has a byte at least
    ahead = np.cumsum(v.sizes[ids_b[:head]])
    keep_a = len(ids_a) - (np.searchsorted(back, tail) + 1) if i else 0
    drop_b = np.searchsorted(ahead, head) + 1 if j < len(b) else len(ids_b)
    window = np.array(v.encoding.encode_ordinary(a[i:] + b[:j]), np.int32)
    return a + b, np.concatenate([ids_a[:keep_a], window, ids_b[drop_b:]])


def encode_all(texts: list[str], path: str = VOCABULARY, leaf: int = LEAF_CHARS) -> list[np.ndarray]:
    """Ids of every text by tree reduction."""
    v = vocabulary(path)
    leaves: list[str] = []
    trees: list = []

    def grow(text: str):
        if len(text) <= leaf:
            leaves.append(text)
            return len(leaves) - 1
        half = len(text) // 2
        return grow(text[:half]), grow(text[half:])

    for text in texts:
        trees.append(grow(text))
    coded = v.plain(leaves)

    def reduce(tree) -> tuple[str, np.ndarray]:
        if isinstance(tree, int):
            return leaves[tree], coded[tree]
        return join(v, reduce(tree[0]), reduce(tree[1]))

    return [coded[t] if isinstance(t, int) else reduce(t)[1] for t in trees]


def decode_all(ids: list, path: str = VOCABULARY) -> list[str]:
    """Texts of ids; pieces are concatenated up the tree, which for bytes is one join."""
    v = vocabulary(path)
    return [v.decode(x) for x in ids]


def encoded(df: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """(key, ids array<int>) of every row of df; key keeps its name and type."""
    ship(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = encode_all([t or "" for t in batch.column(1).to_pylist()], path)
            offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
            flat = np.concatenate(ids) if ids else np.array([], np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "ids"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, ids array<int>")


def decoded(df: DataFrame, key: str, ids: str, path: str = VOCABULARY) -> DataFrame:
    """(key, text) of rows of ids; null ids give null."""
    ship(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(1).to_pylist()
            texts = decode_all([x or [] for x in given], path)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if g is None else t for g, t in zip(given, texts)], pa.string())], names=[key, "text"])

    return df.select(key, ids).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, text string")


def token_counts(df: DataFrame, keep: list[str], text: str, path: str = VOCABULARY) -> DataFrame:
    """The kept columns and n_tokens of every row; null and empty texts have none."""
    ship(df.sparkSession, path)
    fields = [df.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(x) for x in encode_all([t or "" for t in batch.column(len(keep)).to_pylist()], path)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n, pa.int64())], names=[*keep, "n_tokens"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_tokens bigint"
    return df.select(*keep, text).mapInArrow(run, schema)
