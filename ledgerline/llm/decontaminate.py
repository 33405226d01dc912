"""Benchmark decontamination by size-partitioned MinHash containment search (operator 7).

Items are put in classes by number of five-word shingles (at most 8, 16, 32, ...). For the class of at most U shingles
a document is read as windows of 2U shingles, one each U, so any item of the class that stands in a text lies whole in some
window and its Jaccard similarity with that window is bounded from below, however long the document. Windows and items are
compared by 64 MinHash values with one value a band; minima of the larger windows come from those of the smaller ones.
Each candidate is verified: the part of the item's shingles that the whole document holds must reach the threshold.

Chance to find an item of q shingles at containment c: about 1 - (1 - cq / 2U) ** 64, over 0.9999 where q >= U / 2 and c >= 0.8.
Items of up to three shingles, where that chance would be less, are looked up by their shingles themselves. An item of one to
four words is one shingle, the run of its words.

The item index goes to executors in blocks of at most `block_chars` characters of items. Blocks are searched one after the other against
all documents, and each block's result is written before the next index is made, so that neither the driver nor a worker holds more
than one block, however large the benchmark.

Words are lower-cased, ASCII punctuation parts them. Defined results: null texts and texts without words hold nothing, and such items are held
by nothing; a text of any length is searched whole; a containment that ties with the threshold counts; repeated rows each match; an empty
table on either side gives no match; extra columns of any name stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_HASHES, WordHashes, carried, chain_hashes, decode, mix64, text_bytes, tune, written

WIDTH, BASE, FEW = 5, 8, 3
_N_HASHES = 64
_MULTIPLIERS = mix64(np.arange(1, _N_HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_PART = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
HITS = "array<struct<item_id:long,item_shingles:int,shared:int>>"


def word_hashes(raw: bytes, hashes: WordHashes) -> np.ndarray:
    words = decode(raw).lower().encode().translate(_PART).split()
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def runs(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` words; those of different widths differ."""
    return chain_hashes(words, width) ^ np.uint64(width)


class ItemIndex:
    """MinHash values and shingles of a block of items, by size class; the shingles of short ones as they are."""

    def __init__(self, items: list[tuple[int, bytes]]):
        hashes = WordHashes()
        #: id, width of its shingles, shingles
        self.items: list[tuple[int, int, np.ndarray]] = []
        self.bands: dict[int, list[dict[int, list[int]]]] = {}
        by_width: dict[int, dict[int, list[int]]] = {}
        for item_id, raw in items:
            words = word_hashes(raw, hashes)
            width = min(len(words), WIDTH)
            if not width:
                continue
            own = np.unique(runs(words, width))
            if len(own) <= FEW:
                for h in own.tolist():
                    by_width.setdefault(width, {}).setdefault(h, []).append(len(self.items))
            else:
                bands = self.bands.setdefault(max(0, int(np.ceil(np.log2(len(own) / BASE)))), [{} for _ in range(_N_HASHES)])
                for k in range(_N_HASHES):
                    bands[k].setdefault(int((own * _MULTIPLIERS[k]).min()), []).append(len(self.items))
            self.items.append((item_id, width, own))
        self.few = {w: (np.array(sorted(at), np.uint64), at) for w, at in by_width.items()}
        #: By class and band: whether a value with these low 16 bits occurs, and the values.
        self.filters = {}
        for level, bands in self.bands.items():
            values = [np.fromiter(b, np.uint64, len(b)) for b in bands]
            seen = np.zeros((_N_HASHES, 1 << 16), bool)
            for k, v in enumerate(values):
                seen[k, (v & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.filters[level] = seen

    def search(self, raws: list[bytes], threshold: float) -> list[list[tuple[int, int, int]]]:
        """For each text its items of at least the threshold's containment: id, shingles, shared shingles."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in raws]
        if not self.items:
            return found
        words = [word_hashes(r, WORD_HASHES) for r in raws]
        docs = [runs(w, WIDTH) for w in words]
        pairs = self._few_pairs(words, docs)
        filled = [i for i, d in enumerate(docs) if len(d)]
        if filled and self.bands:
            pairs |= self._long_pairs(docs, filled)
        for at, item in pairs:
            item_id, width, own = self.items[item]
            shared = int(np.isin(own, docs[at] if width == WIDTH else runs(words[at], width)).sum())
            if shared >= threshold * len(own):
                found[at].append((item_id, len(own), shared))
        return [sorted(f) for f in found]

    def _few_pairs(self, words: list[np.ndarray], docs: list[np.ndarray]) -> set[tuple[int, int]]:
        """(text, item) that share a shingle, for items of few shingles."""
        pairs: set[tuple[int, int]] = set()
        for width, (sorted_runs, at) in self.few.items():
            for i, w in enumerate(words):
                own = docs[i] if width == WIDTH else runs(w, width)
                place = np.minimum(np.searchsorted(sorted_runs, own), len(sorted_runs) - 1)
                for h in np.unique(own[sorted_runs[place] == own]).tolist():
                    pairs.update((i, item) for item in at[h])
        return pairs

    def _long_pairs(self, docs: list[np.ndarray], filled: list[int]) -> set[tuple[int, int]]:
        """(text, item) that agree in a band of a window."""
        joined = np.concatenate([docs[i] for i in filled])
        n_blocks = np.array([-(-len(docs[i]) // BASE) for i in filled])
        starts = np.concatenate([at + np.arange(0, len(docs[i]), BASE) for i, at in zip(filled, np.cumsum([0, *(len(docs[i]) for i in filled[:-1])]), strict=True)])
        low = np.stack([np.minimum.reduceat(joined * m, starts) for m in _MULTIPLIERS])  # hash function, block
        pairs: set[tuple[int, int]] = set()
        for level in range(max(self.bands) + 1):
            if level:  # blocks of twice the size, by document
                first = np.concatenate([at + np.arange(0, n, 2) for n, at in zip(n_blocks, np.cumsum([0, *n_blocks[:-1]]), strict=True)])
                low = np.minimum.reduceat(low, first, axis=1)
                n_blocks = -(-n_blocks // 2)
            if level not in self.bands:
                continue
            owner = np.repeat(np.arange(len(filled)), n_blocks)
            windows = low.copy()
            windows[:, :-1] = np.where(owner[1:] == owner[:-1], np.minimum(low[:, :-1], low[:, 1:]), low[:, :-1])
            for k in range(_N_HASHES):
                maybe = np.flatnonzero(self.filters[level][k][(windows[k] & np.uint64(0xFFFF)).astype(np.int64)])
                band = self.bands[level][k]
                for w, value in zip(maybe.tolist(), windows[k][maybe].tolist(), strict=True):
                    for item in band.get(value, ()):
                        pairs.add((filled[int(owner[w])], item))
        return pairs


def _item_blocks(items: DataFrame, block_chars: int):
    """The items, a bounded block at a time."""
    rows = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), text_bytes().alias("raw"))
    total = rows.agg(F.sum(F.length("raw"))).first()[0] or 0
    n = -(-total // block_chars)
    for i in range(n):
        block = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i)
        yield [(r["item_id"], bytes(r["raw"])) for r in block.collect()]


def _searches(docs: DataFrame, items: DataFrame, threshold: float, block_chars: int):
    """For each block of items a function from the bytes of a text to its hits, and whether it is the last."""
    spark = docs.sparkSession
    tune(spark)
    block = None
    for following in _item_blocks(items, block_chars):
        if block is not None:
            shared = spark.sparkContext.broadcast(ItemIndex(block))
            yield _search_udf(shared, threshold), False
            shared.destroy()  # its result is written
        block = following
    if block is not None:
        yield _search_udf(spark.sparkContext.broadcast(ItemIndex(block)), threshold), True


def _search_udf(index, threshold: float):
    @F.arrow_udf(HITS)
    def hits(raw: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("item_shingles", pa.int32()), ("shared", pa.int32())]))
        found = index.value.search(raw.to_pylist(), threshold)
        return pa.array([[{"item_id": i, "item_shingles": n, "shared": s} for i, n, s in f] for f in found], kind)

    return hits


def leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8, block_chars: int = 4_000_000) -> DataFrame:
    """A row for each document and item that it holds: doc_id, item_id, item_shingles, shared, containment."""
    out = docs.select("doc_id", F.explode(F.array().cast(HITS)).alias("h")).where("false")
    for k, (hits, last) in enumerate(_searches(docs, items, threshold, block_chars)):
        found = docs.select("doc_id", F.explode(hits(text_bytes())).alias("h"))
        found = found if last else written(found, "leaks")
        out = out.unionByName(found) if k else found
    return out.select("doc_id", F.col("h.item_id").alias("item_id"), F.col("h.item_shingles").cast("long").alias("item_shingles"), F.col("h.shared").cast("long").alias("shared"), (F.col("h.shared") / F.col("h.item_shingles")).alias("containment"))


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = 0.8, block_chars: int = 4_000_000) -> DataFrame:
    """docs without those that hold an item; their columns stay."""
    left = carried(docs)
    for hits, last in _searches(docs, items, threshold, block_chars):
        left = left.where(F.size(hits(text_bytes("row.text"))) == 0)
        left = left if last else written(left, "clean")
    return left.select("row.*")
