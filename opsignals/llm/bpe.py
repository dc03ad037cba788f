"""BPE encoding and decoding with a contiguous rank array (operator 4).

``BpeCodec`` reads a tokenizer file whose words end in a suffix. A word is a row of parts with the
rank of each adjacent pair beside it: the lowest rank is found by scanning, one boundary goes, and
the two ranks next to it are looked up again. A word of over ``SHORT_WORD`` parts keeps the same
pairs in a heap, so that its time grows by n log n. Results equal the tokenizers library's.

A null text is encoded as an empty one: no ids, and the empty string decoded. Rows are kept as they
come, repeated ids included; other columns are left behind.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsignals.llm.common import sha256_hex, slices, small_batches, table, texts
from opsignals.llm.tokens import ChunkMemo, tokenizer_file

SHORT_WORD = 96
_NONE = 1 << 60
_SPACE = regex.compile("[\t-\r \x85\xa0  -     　]+")


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if it prints, else the next free code from 256."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return [chr(b) if b in prints else chr(256 + rest.index(b)) for b in range(256)]


class BpeCodec:
    """Encodes and decodes by one tokenizer file (NFC, single spaces, lower case, words with an end suffix)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.letter = [self.vocab[c] for c in byte_letters()]
        self.last_letter = [self.vocab[c + suffix] for c in byte_letters()]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for left, right in model["merges"]:
            self.rank[self.vocab[left], self.vocab[right]] = len(self.made)
            self.made.append(self.vocab[left + right])
        names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            part = _SPACE.sub(" ", unicodedata.normalize("NFC", part))
            part = "".join(map(str.lower, part)) if "Σ" in part else part.lower()
            for word in self.words.findall(part):
                out += self.merge(word.encode())
        return out

    def merge(self, word: bytes) -> list[int]:
        parts = [self.letter[b] for b in word[:-1]] + [self.last_letter[word[-1]]]
        if len(parts) > SHORT_WORD:
            return self._merge_long(parts)
        look, made = self.rank.get, self.made
        ranks = [look(pair, _NONE) for pair in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == _NONE:
                break
            i = ranks.index(low)
            parts[i] = made[low]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = look((parts[i], parts[i + 1]), _NONE)
            if i:
                ranks[i - 1] = look((parts[i - 1], parts[i]), _NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, look = len(parts), self.rank.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, i + 1) for i in range(n - 1) if (r := look((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, j = heapq.heappop(heap)
            if parts[i] < 0 or after[i] != j or look((parts[i], parts[j])) != r:
                continue
            parts[i], parts[j], after[i] = self.made[r], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := look((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (r, a, b))
        return [p for p in parts if p >= 0]

    def decode(self, ids: Iterable[int]) -> bytes:
        """UTF-8 of the tokens with a space between, as a file without a decoder has it."""
        return b" ".join(map(self.names.__getitem__, ids))


_CODECS: dict[str, tuple[BpeCodec, ChunkMemo]] = {}


def codec(path: str) -> tuple[BpeCodec, ChunkMemo]:
    if path not in _CODECS:
        own = BpeCodec(path)
        memo = ChunkMemo(lambda chunks: (np.array(own.encode(c), dtype="<u4").tobytes() for c in chunks))
        _CODECS[path] = own, memo
    return _CODECS[path]


def bpe_encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and ids (binary, little-endian unsigned 32-bit) of every whole text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = codec(path)[1]
        for batch in slices(batches, "text"):
            flat, ends = memo.ids(batch.column("text"))
            ids = pa.array([flat[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())
            counts = pa.array(np.diff(ends), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, ids], ["doc_id", "n_tokens", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """The encoded rows with ``decoded``, the text of their ids."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)[0]
        for batch in slices(batches, "ids", 8 << 20):
            ids = (np.frombuffer(b, "<u4").tolist() for b in batch.column("ids").to_pylist())
            decoded = pa.array([own.decode(i) for i in ids], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file("word_bpe_49k.json")
    both = bpe_decode(bpe_encode(table(spark, sf_dir, "documents"), path), path)
    return both.select(
        "doc_id",
        "n_tokens",
        sha256_hex(F.col("ids")).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"),
    )
