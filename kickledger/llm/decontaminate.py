"""Benchmark decontamination: an FM-index per training shard, searched for every benchmark window.

A shard is a run of documents of one Arrow batch, of ``SHARD_WORDS`` words
at most; a longer document is indexed in overlapping parts. Words are coded
by the vocabulary of the windows. Any other word can be part of no window,
so it ends a stretch, and stretches shorter than the shortest window hold no
occurrence: only the remaining stretches enter the index, which changes no
result. All windows are searched backward together, through wavelet-tree
ranks; occurrences are located by sampled suffix positions and merged into
spans of document words.

The benchmark is the stated query set: it goes to the workers in blocks of
``BLOCK_BYTES`` of text, one pass over the documents per block, so what is
sent at once stays bounded however large the benchmark gets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import common
from .fm_index import FMIndex

WINDOW = 10
SHARD_WORDS = 1 << 22
BLOCK_BYTES = 32 << 20
_PART = 1 << 20

# Words are runs of 0-9, a-z (A-Z lowered) and all bytes from 0x80; every other byte becomes a space.
_CODES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))
_IN_WORD = np.array([_CODES[b] != 0x20 for b in range(256)])


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in parts of about a megabyte of text."""
    text = text.translate(_CODES)
    at = 0
    while at < len(text):
        end = len(text) if len(text) - at <= _PART else text.find(b" ", at + _PART)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


class Phrases:
    """Distinct windows of a block of benchmark items, coded by their own vocabulary."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.ids, self.vocabulary = [], _Vocabulary()
        owners: dict[tuple, set[int]] = {}
        for item_id, text in items:
            words = [w for part in words_of((text or "").encode()) for w in part]
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            self.ids.append(item_id)
            for at in range(max(1, len(codes) - window + 1) if codes else 0):
                owners.setdefault(tuple(codes[at:at + window]), set()).add(len(self.ids) - 1)
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.codes = np.zeros((len(owners), window), np.int64)
        for k, w in enumerate(owners):
            self.codes[k, :len(w)] = w
        self.owner_counts = np.array([len(x) for x in owners.values()], np.int64)
        self.owners = np.array([i for x in owners.values() for i in sorted(x)], np.int64)
        self.owner_starts = np.cumsum(self.owner_counts) - self.owner_counts


    def state(self) -> dict:
        """Plain values, as a broadcast variable needs."""
        return self.__dict__ | {"vocabulary": dict(self.vocabulary)}

    @classmethod
    def of(cls, state: dict) -> Phrases:
        phrases = cls.__new__(cls)
        phrases.__dict__.update(state | {"vocabulary": _Vocabulary(state["vocabulary"])})
        return phrases


def _index_and_search(codes: list[np.ndarray], phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, position in the concatenated codes) of all occurrences inside the given pieces."""
    flat = np.concatenate([x for c in codes for x in (c, np.zeros(1, c.dtype))])
    known = np.concatenate([[False], flat > 0, [False]])
    starts, ends = np.flatnonzero(known[1:] & ~known[:-1]), np.flatnonzero(known[:-1] & ~known[1:])
    long = ends - starts >= phrases.lengths.min()
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    sizes = ends - starts + 1                      # each stretch with the 0 that follows it
    kept_at = np.cumsum(sizes) - sizes
    kept = flat[np.arange(sizes.sum()) + np.repeat(starts - kept_at, sizes)].astype(np.int64)
    index = FMIndex(kept, len(phrases.vocabulary))
    lo, hi = index.search(phrases.codes, phrases.lengths)
    counts = hi - lo
    rows = np.arange(counts.sum()) + np.repeat(lo - (np.cumsum(counts) - counts), counts)
    found = index.locate(rows)
    stretch = np.searchsorted(kept_at, found, side="right") - 1
    return np.repeat(np.arange(len(counts)), counts), found - kept_at[stretch] + starts[stretch]


def scan_texts(texts: list[bytes], phrases: Phrases, shard_words: int = SHARD_WORDS) -> list[tuple]:
    """Per text: (number of words, hit spans of words as (k, 2) array, item ids sorted)."""
    pieces: list[tuple[int, int, np.ndarray]] = []  # (text, first word, codes)
    out, total = [None] * len(texts), 0
    n_words = np.zeros(len(texts), np.int64)
    spans = [np.empty((0, 2), np.int64)] * len(texts)
    items: list[set] = [set()] * len(texts)
    overlap = phrases.codes.shape[1] - 1

    def flush() -> None:
        nonlocal pieces, total
        if pieces and len(phrases.lengths):
            window, at = _index_and_search([p[2] for p in pieces], phrases)
            lengths = np.array([len(p[2]) for p in pieces]) + 1
            piece_at = np.cumsum(lengths) - lengths
            piece = np.searchsorted(piece_at, at, side="right") - 1
            owner = np.array([p[0] for p in pieces])[piece]
            first = at - piece_at[piece] + np.array([p[1] for p in pieces])[piece]
            last = first + phrases.lengths[window]
            order = np.lexsort((first, owner))
            for part in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1) if len(order) else []:
                k = owner[part[0]]
                spans[k] = merged(np.concatenate([spans[k], np.stack([first[part], last[part]], 1)]))
                seen = np.unique(window[part])
                counts = phrases.owner_counts[seen]
                of = phrases.owners[np.arange(counts.sum()) + np.repeat(
                    phrases.owner_starts[seen] - (np.cumsum(counts) - counts), counts)]
                items[k] = items[k] | {phrases.ids[i] for i in np.unique(of)} - {None}
        pieces, total = [], 0

    code = phrases.vocabulary.__getitem__
    for k, text in enumerate(texts):
        tail = np.empty(0, np.int32)
        for words in words_of(text):
            codes = np.fromiter(map(code, words), np.int32, len(words))
            pieces.append((k, int(n_words[k]) - len(tail), np.concatenate([tail, codes])))
            n_words[k] += len(codes)
            total += len(codes)
            tail = pieces[-1][2][max(0, len(pieces[-1][2]) - overlap):] if overlap else tail
            if total >= shard_words:
                flush()
    flush()
    for k in range(len(texts)):
        out[k] = (int(n_words[k]), spans[k], sorted(items[k]))
    return out


def merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping or touching [start, end) spans joined."""
    if len(spans) < 2:
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    heads = np.flatnonzero(new)
    return np.stack([spans[heads, 0], reach[np.append(heads[1:], len(spans)) - 1]], 1)


def cut(text: bytes, spans: np.ndarray) -> bytes:
    """The text without the bytes from each span's first word to its last."""
    inside = np.concatenate([[False], _IN_WORD[np.frombuffer(text, np.uint8)], [False]])
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    edges = [0, *np.stack([starts[spans[:, 0]], ends[spans[:, 1] - 1]], 1).ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Phrases]:
    """The benchmark's items, collected block by block; null texts have no words."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = size // block_bytes + 1
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield Phrases([(r[0], r[1]) for r in block.collect()], window)


_FOUND = "n_words long, spans array<struct<first:long,last:long>>, items array<string>"


def _scan(rows: DataFrame, phrases: Phrases, shard_words: int) -> DataFrame:
    """rows (key, text) to (key, n_words, spans, items)."""
    sent = rows.sparkSession.sparkContext.broadcast(phrases.state())
    key = rows.schema[0]
    span = pa.struct([("first", pa.int64()), ("last", pa.int64())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Phrases.of(sent.value)
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column(1)]
            found = scan_texts(texts, wanted, shard_words)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([f[0] for f in found], pa.int64()),
                pa.array([[{"first": a, "last": b} for a, b in f[1].tolist()] for f in found], pa.list_(span)),
                pa.array([f[2] for f in found], pa.list_(pa.string()))], [key.name, "n_words", "spans", "items"])

    return rows.mapInArrow(of, f"`{key.name}` long, {_FOUND}")


def _scan_blocks(rows: DataFrame, blocks: Iterable[Phrases], shard_words: int) -> DataFrame:
    """rows (row, text) to (row, n_words, spans, items), a row for each block, stored block by block."""
    parts = None
    for phrases in blocks:
        part = materialize(_scan(rows, phrases, shard_words), "decontamination-block")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
         shard_words: int = SHARD_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, spans, items) per row: hit spans [first, last) of words, and the items found.

    An item shorter than the window is one window; an item without words is
    none; one without an id hits words but is not listed in ``items``. Null and empty texts have no words and no hits; repeated rows give
    a row each; an empty table gives no rows, an empty benchmark no hits.
    """
    rows = common.ids_and_texts(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    blocks = _blocks(benchmark, window, block_bytes)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        return _scan(rows, first, shard_words)
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "decontamination-rows")
    parts = _scan_blocks(rows.select("row", "text"), chain((first, second), blocks), shard_words)
    whole = parts.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = F.aggregate("spans", F.expr("CAST(array() AS array<struct<first:bigint,last:bigint>>)"), lambda done, s: F.when(
        (F.size(done) > 0) & (s["first"] <= F.element_at(done, -1)["last"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["first"].alias("first"),
            F.greatest(F.element_at(done, -1)["last"], s["last"]).alias("last"))))).otherwise(
        F.concat(done, F.array(s))))
    return rows.select("row", "doc_id").join(whole, "row").select("doc_id", "n_words", joined.alias("spans"), "items")


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
           shard_words: int = SHARD_WORDS, text_col: str = "text", count_col: str = "n_chars") -> DataFrame:
    """The documents, all columns and rows kept, with every hit span cut from the text.

    Texts without a hit, and nulls, come back unchanged; where a text changes,
    ``count_col`` (if there is one) is set to its new length. For a benchmark
    of several blocks, each block's spans are found in the original text,
    merged over all blocks, and cut at once: where blocks part changes nothing.
    """
    names = docs.columns
    at, count = names.index(text_col), names.index(count_col) if count_col in names else None

    def cleaned(batch: pa.RecordBatch, spans_of: Callable[[list[bytes]], list[np.ndarray]]) -> pa.RecordBatch:
        columns = batch.columns[:len(names)]
        texts = [t.as_buffer().to_pybytes() if t.is_valid else None for t in columns[at].cast(pa.binary())]
        spans = spans_of([t or b"" for t in texts])
        texts = [cut(t, s) if len(s) else t for t, s in zip(texts, spans)]
        columns[at] = pa.array(texts, pa.binary()).cast(columns[at].type)
        if count is not None:
            old = columns[count].to_pylist()
            columns[count] = pa.array([len(t.decode()) if len(s) else n for t, s, n in zip(texts, spans, old)],
                                      columns[count].type)
        return pa.RecordBatch.from_arrays(columns, names)

    blocks = _blocks(benchmark, window, block_bytes)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        sent = docs.sparkSession.sparkContext.broadcast(first.state())

        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted = Phrases.of(sent.value)
            for batch in batches:
                yield cleaned(batch, lambda texts: [f[1] for f in scan_texts(texts, wanted, shard_words)])

        return docs.mapInArrow(of, docs.schema)

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [np.array([(s["first"], s["last"]) for s in found or ()], np.int64).reshape(-1, 2)
                     for found in batch.column(len(names)).to_pylist()]
            yield cleaned(batch, lambda _, spans=spans: [merged(s) for s in spans])

    places = [f"c{k}" for k in range(len(names))]
    rows = materialize(docs.toDF(*places).withColumn("row", F.monotonically_increasing_id()), "decontamination-rows")
    texts = rows.select("row", F.coalesce(F.col(places[at]).cast("string"), F.lit("")).cast("binary").alias("text"))
    parts = _scan_blocks(texts, chain((first, second), blocks), shard_words)
    whole = parts.filter(F.size("spans") > 0).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return rows.join(whole, "row", "left").select(*places, "spans").mapInArrow(at_once, docs.schema)


def op10_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        common.sha256_hex(F.array_join("items", ",")).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))
