"""Packing documents into token sequences along a space-filling curve (operator 2).

A document's token ids are counted in hashed buckets, the vector is projected to a few dimensions, and its cell's place
on the Hilbert curve is its key. Documents are range-partitioned and sorted by key; each partition fills sequences
of exactly `size` ids from neighbours on the curve, cutting documents where a sequence ends. What is left at a partition's
end goes to sequences whose lengths are powers of two, so no sequence needs padding.

Defined results: a null or empty text is the end id alone; repeated rows and null doc_ids are packed like any other row;
an empty table gives no piece; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import json
import itertools
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import decode, mix64, text_bytes, tune, written

_BUCKETS, _DIMENSIONS, _BITS = 256, 3, 16


def _byte_letters() -> dict[int, str]:
    """Byte-level models write a byte as a character: a printable one as itself, the others as those from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()
#: The tokenizer's own split, for printable ASCII in lower case.
_ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_PRINTABLE = re.compile(r"[!-~]+")
_WORD_AND_MARKS = re.compile(r"([^!-~]*[^!-&(-~])([!-&(-/:-@\[-`{-~]+)")


def _little(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


#: The normaliser and the split of words that the short way below writes out; any other goes through the tokenizer's whole chain.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def written_out(chain) -> bool:
    """Asked once, on the driver: whether a tokenizer has the normaliser and split that TokenCache writes out, and special tokens that begin with <| only."""
    spec = json.loads(chain.to_str())
    same = spec["normalizer"] == _NORMALIZER and spec["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]}
    return same and spec["post_processor"] is None and all(t["content"].startswith("<|") for t in spec["added_tokens"])


class TokenCache(dict):
    """Ids (little-endian 16-bit) by ASCII-space separated chunk, in two generations of bounded size.

    The tokenizer drops white space before it splits, so chunks are tokenized apart. Chunks of printable ASCII and words of
    European letters, with or without marks after them, go straight to its model, which takes a tenth of the time of its
    whole chain; all others go through the chain. A tokenizer of another build gets whole texts (`written_out`).
    """

    def __init__(self, path: str, whole: bool | None = None, most: int = 450_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.chain, self.most, self.old = Tokenizer.from_file(path), most, {}
        self.model = self.chain.model
        self.whole = not written_out(self.chain) if whole is None else whole
        if self.chain.get_vocab_size() > 1 << 16:
            raise ValueError(f"{path} has {self.chain.get_vocab_size()} ids; packing holds ids in 16 bits")

    def _of_part(self, part: str) -> bytes:
        written = part if part.isascii() else "".join(map(_LETTERS.__getitem__, part.encode()))
        return _little(array("H", [t.id for t in self.model.tokenize(written)]))

    def _of_chunk(self, chunk: bytes) -> bytes:
        text = decode(chunk)
        if "<|" not in text:  # no special token
            if _PRINTABLE.fullmatch(text):
                parts = _ASCII_PARTS.findall(text.lower())
                return self._of_part(parts[0]) if len(parts) == 1 else b"".join(self[p.encode()] for p in parts)
            if max(text) < "\u0250" and "\u0130" not in text:  # whose lower case is two characters
                word = unicodedata.normalize("NFC", text)
                if word.isalpha():
                    return self._of_part(word.lower())
                if (m := _WORD_AND_MARKS.fullmatch(text)) and m[1].isalpha():
                    return self[m[1].encode()] + self[m[2].encode()]
        return _little(array("H", self.chain.encode(text, add_special_tokens=False).ids))

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self._of_chunk(chunk)
        if len(self) >= self.most:
            self.old.clear()
            self.old.update(self)
            self.clear()
        self[chunk] = ids
        return ids

    def encode(self, raw: bytes) -> bytes:
        if self.whole:
            return _little(array("H", self.chain.encode(decode(raw), add_special_tokens=False).ids))
        raw = decode(raw).encode()
        # Lower case is the tokenizer's own; done first it makes fewer chunks. A text that could name a special token is left.
        return b"".join(map(self.__getitem__, (raw if b"<|" in raw else raw.lower()).split()))


_caches: dict[str, TokenCache] = {}


def token_cache(path: str, whole: bool) -> TokenCache:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _caches:
        _caches[path] = TokenCache(path, whole)
    return _caches[path]


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of coordinates (0 to 2 ** bits - 1), after Skilling's transform."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        for i in range(dims):
            flip = (x[i] & q) != 0
            t = np.where(flip, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(flip, q - 1, t)
            if i:
                x[i] ^= t
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        t = np.where((x[dims - 1] & (1 << level)) != 0, t ^ ((1 << level) - 1), t)
    x ^= t
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def curve_keys(documents: list[np.ndarray]) -> np.ndarray:
    """Hilbert key of each document's hashed id counts."""
    bucket = (mix64(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(_BUCKETS)).astype(np.int64)
    vectors = np.array([np.bincount(bucket[ids], minlength=_BUCKETS) for ids in documents], float).reshape(-1, _BUCKETS)
    vectors = np.sqrt(vectors)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    axes = np.random.default_rng(7).standard_normal((_BUCKETS, _DIMENSIONS))
    cells = np.clip((vectors @ axes + 3) / 6, 0, 1 - 1e-9) * (1 << _BITS)
    return hilbert_index(cells.astype(np.int64), _BITS)


def _tokenized(path: str, whole: bool, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, end, zip_ = token_cache(path, whole), np.array([end_id], "<u2").tobytes(), zstandard.ZstdCompressor(1)
        for b in batches:
            raws = [cache.encode(r) + end for r in b.column(1).to_pylist()]
            arrays = [np.frombuffer(r, "<u2") for r in raws]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(curve_keys(arrays)), pa.array([len(a) for a in arrays], pa.int64()), pa.array(map(zip_.compress, raws), pa.binary())], ["doc_id", "curve_key", "doc_tokens", "packed_ids"])

    return run


def _powers(n: int) -> list[int]:
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


def _filled(size: int):
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [pa.int64()] * 6 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        sequence = itertools.count(TaskContext.get().partitionId() << 36)
        pending: list[tuple[int, int, np.ndarray, int]] = []  # doc_id, start, ids, doc_tokens: less than a sequence
        held, out = 0, []

        def place(length: int) -> None:
            """The next `length` pending ids become a sequence."""
            nonlocal held
            sid, offset = next(sequence), 0
            held -= length
            while offset < length:
                doc_id, start, ids, total = pending[0]
                n = min(len(ids), length - offset)
                out.append((doc_id, start, n, total, sid, offset, ids[:n].astype("<u4").tobytes()))
                if n == len(ids):
                    pending.pop(0)
                else:
                    pending[0] = (doc_id, start + n, ids[n:], total)
                offset += n

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            found = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
            out.clear()
            return found

        for b in batches:
            for doc_id, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(unzip.decompress(raw), "<u2")
                pending.append((doc_id, 0, ids, len(ids)))
                held += len(ids)
                while held >= size:
                    place(size)
                if len(out) > 2048:
                    yield batch()
        for n in _powers(held):
            place(n)
        yield batch()

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of documents: doc_id, start, length, doc_tokens, sequence_id, offset and ids (little-endian 32-bit)."""
    tune(docs.sparkSession)
    whole = TokenCache(tokenizer_path).whole
    tokens = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("raw")).mapInArrow(_tokenized(tokenizer_path, whole, end_id), "doc_id long, curve_key long, doc_tokens long, packed_ids binary")
    ordered = written(tokens, "tokens").repartitionByRange("curve_key", "doc_id").sortWithinPartitions("curve_key", "doc_id")
    return ordered.select("doc_id", "packed_ids").mapInArrow(_filled(size), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def packing_report(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    return pack_documents(docs, tokenizer_path).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
