"""BPE encoding and decoding.

Encoding keeps the symbols of a pre-token in a doubly linked list and a priority
queue of (merge rank, position).  A popped entry whose pair no longer stands at
its position is stale and skipped.  Decoding concatenates vocabulary strings and
maps their characters back to bytes.

Both work on byte-level BPE files of the ``tokenizers`` JSON format; the file's
path is a parameter and the file is read on the driver and broadcast (its size is
checked against ``MAX_VOCAB_BYTES`` first).

Cases: null text encodes like the empty text (0 tokens, digests of the empty
string).  A special token's string inside a text becomes its id.  Texts of any
length are encoded in blocks of pre-tokens, so memory follows the longest
pre-token and not the text.  Repeated rows are encoded alike; extra columns are
left alone by ``with_encoding`` (the result column takes a free name).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice
from operator import itemgetter

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import col, free_name, small_batches, text_udf

MAX_VOCAB_BYTES = 64 << 20
BLOCK = 1 << 16              # pre-tokens that are held at once
CACHE_ENTRIES = 1 << 18      # encoded pre-tokens kept per Python worker
CACHE_KEY = 64               # longest pre-token that is kept



@lru_cache(maxsize=2)
def pretoken_pattern(limit: int) -> re.Pattern:
    """The pre-token pattern of byte-level BPE vocabularies, for texts of code points below
    ``limit``.  The standard library's matcher is several times faster than ``regex`` but
    lacks Unicode properties, so the ranges of letters, numbers and white space are taken
    from ``regex``; sets within the basic plane compile to a table, wider ones to a list."""
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, limit))))

    def ranges(name: str) -> str:
        runs = regex.findall(rf"\p{{{name}}}+", every)
        return "".join(f"\\U{ord(r[0]):08x}-\\U{ord(r[0]) + len(r) - 1:08x}" for r in runs)

    letter, number, space = map(ranges, ("L", "N", "White_Space"))
    # The contractions.  Letters, the most frequent branch, come first; no
    # contraction starts with a letter, so the order does not change what is matched.
    return re.compile(f" ?[{letter}]+|'(?:s|t|re|ve|m|ll|d)| ?[{number}]+| ?[^{space}{letter}{number}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+")


BASIC_PLANE = 0x10000
_BEYOND = re.compile(r"[^\u0000-\uffff]")


def pretokens(text: str) -> re.Pattern:
    """The fastest pattern that is right for the text."""
    return pretoken_pattern(0x110000 if _BEYOND.search(text) else BASIC_PLANE)


@lru_cache(maxsize=1)
def byte_chars() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable
    Latin-1 stands for itself, the other bytes take the code points from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class ByteBpe(dict):
    """Encoder and decoder for one vocabulary.  As a dict it keeps encoded pre-tokens:
    pre-token -> (ids, the ids as decimal text)."""

    def __init__(self, spec: str):
        super().__init__()
        j = json.loads(spec)
        vocab = j["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in j["model"]["merges"]]
        self.width = 1 + max(vocab.values())
        self.rank = {vocab[a] * self.width + vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.byte_id = [vocab[c] for c in byte_chars()]
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        to_byte = {c: b for b, c in enumerate(byte_chars())}
        self.strings = {i: bytes(map(to_byte.__getitem__, s)) for s, i in (vocab | self.special).items()}
        longest = sorted(self.special, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def merge(self, ids: list[int]) -> list[int]:
        """Apply the merges to one pre-token's symbols, lowest rank first, leftmost first.

        ``pair[i]`` is the rank of the pair that now starts at i (-1: none); the queue
        holds rank * n + i.  An entry whose rank is no longer ``pair[i]`` is stale."""
        n, width, rank, made = len(ids), self.width, self.rank.get, self.made
        pair = [rank(a * width + b, -1) for a, b in zip(ids, ids[1:], strict=False)]
        queue = [r * n + i for i, r in enumerate(pair) if r >= 0]
        if not queue:
            return ids
        pair.append(-1)
        heapq.heapify(queue)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))     # n: the end
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            r, i = divmod(pop(queue), n)
            if pair[i] != r:
                continue
            j = right[i]
            new = ids[i] = made[r]
            ids[j] = pair[j] = -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                r = pair[i] = rank(new * width + ids[k], -1)
                if r >= 0:
                    push(queue, r * n + i)
            else:
                pair[i] = -1
            h = left[i]
            if h >= 0:
                r = pair[h] = rank(ids[h] * width + new, -1)
                if r >= 0:
                    push(queue, r * n + h)
        return [x for x in ids if x >= 0]

    def __missing__(self, s: str) -> tuple[tuple[int, ...], str]:
        byte_id = self.byte_id
        ids = self.merge([byte_id[b] for b in s.encode()])
        found = tuple(ids), ",".join(map(str, ids))
        if len(s) <= CACHE_KEY:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[s] = found
        return found

    def blocks(self, text: str) -> Iterator[list[tuple[tuple[int, ...], str]]]:
        """Encoded pre-tokens of the text in blocks of at most BLOCK."""
        for part in self.split.split(text) if self.split else [text]:
            if part in self.special:
                yield [((self.special[part],), str(self.special[part]))]
            elif len(part) <= BLOCK:
                yield list(map(self.__getitem__, pretokens(part).findall(part)))
            else:
                words = (m.group() for m in pretokens(part).finditer(part))
                while block := list(map(self.__getitem__, islice(words, BLOCK))):
                    yield block

    def encode(self, text: str | None) -> list[int]:
        return [i for block in self.blocks(text or "") for ids, _ in block for i in ids]

    def decode_bytes(self, ids: list[int]) -> bytes:
        """Concatenated vocabulary strings, which are kept as the bytes they stand for."""
        return b"".join(map(self.strings.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Token count, SHA-256 of the comma-joined ids and of the decoded text."""
        n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
        for block in self.blocks(text or ""):
            if not block:
                continue
            ids = list(chain.from_iterable(map(itemgetter(0), block)))
            of_ids.update(((n > 0) * "," + ",".join(map(itemgetter(1), block))).encode())
            of_text.update(self.decode_bytes(ids))
            n += len(ids)
        return n, of_ids.hexdigest(), of_text.hexdigest()


@lru_cache(maxsize=2)
def _coder(spec: str) -> ByteBpe:
    return ByteBpe(spec)


def vocabulary(spark: SparkSession, path: str):
    """The vocabulary file as a broadcast; refuses files over MAX_VOCAB_BYTES."""
    small_batches(spark)
    if os.path.getsize(path) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCAB_BYTES} bytes")
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_column(spec, text: Column) -> Column:
    """Array of token ids of a text column."""
    def run(s: pd.Series) -> pd.Series:
        coder = _coder(spec.value)
        return pd.Series([coder.encode(t) for t in s], dtype=object)
    return text_udf(run, "array<int>")(text)


def decode_column(spec, ids: Column) -> Column:
    """Text of a column of token ids (null ids: null)."""
    def run(s: pd.Series) -> pd.Series:
        coder = _coder(spec.value)
        return pd.Series([None if x is None else coder.decode(list(map(int, x))) for x in s], dtype=object)
    return text_udf(run, "string")(ids)


def digest_column(spec, text: Column) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256) of an encode and decode round trip."""
    def run(s: pd.Series) -> pd.DataFrame:
        coder = _coder(spec.value)
        return pd.DataFrame([coder.digest(t) for t in s], columns=["n_tokens", "ids_sha256", "decoded_sha256"])
    return text_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string")(text)


def with_encoding(docs: DataFrame, path: str, text: str = "text", name: str = "token_ids") -> DataFrame:
    """``docs`` with one more column, the token ids of ``text``."""
    spec = vocabulary(docs.sparkSession, path)
    return docs.withColumn(free_name(docs, name), encode_column(spec, col(docs, text)))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    spec = vocabulary(docs.sparkSession, path)
    out = docs.select(col(docs, "doc_id").alias("doc_id"), digest_column(spec, col(docs, "text")).alias("_d"))
    return out.select("doc_id", F.col("_d.n_tokens"), F.col("_d.ids_sha256"), F.col("_d.decoded_sha256"))
