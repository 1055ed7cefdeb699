"""Ranked lexical search: the highest inner products, found with norm buckets.

A document is a vector of impacts, one coordinate per query term it holds:
w * ((1000000000 tf) div (1000 tf + 20 m)). An item is the 0/1 vector of its
terms, so a score is an inner product. Each shard (a batch of stored vectors)
orders its vectors by length and cuts the order into buckets, the longest
first. For an item with threshold t, its lowest kept score so far:

- Cauchy-Schwarz: where |item| * longest length of the bucket < t, this and
  all later buckets hold nothing for the item;
- coordinate bounds: the bucket's highest impact per term bounds each
  coordinate. Where these sum to less than t the bucket holds nothing;
  otherwise terms are taken by falling bound until those left sum to less
  than t: a document without any of the terms taken can't reach t. Of the
  others, the sum so far plus the Cauchy-Schwarz bound of what is left of
  item and vector must reach t;
- what survives is rescored exactly in 64-bit integers.

Bounds in floating point get a relative slack; equal scores are never cut.
Items go in blocks of bounded size, since a block's terms and weights travel
to every task; texts are read once a block, and searched as stored vectors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from . import common

TOP = 50
LENGTH_SHARE = 50          # percent of the length in a document's m
SATURATION = 20
BLOCK_BYTES = 8 << 20      # of item texts whose terms travel together
BUCKET = 1024              # vectors
SLACK = 1.0 + 1e-9

#: Bytes of a text to bytes of its terms: letters lower, all else below 0x80 but letters and digits a blank.
_MAP = bytearray(range(256))
for _byte in range(0x80):
    if not re.match(rb"[0-9A-Za-z]", bytes([_byte])):
        _MAP[_byte] = 0x20
_MAP[0x41:0x5B] = range(0x61, 0x7B)
_MAP = bytes(_MAP)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_MAP).split()


def item_blocks(rows: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """Lists of (row, text), each of about ``block_bytes`` of text at most (a longer text is one by itself)."""
    held, size = [], 0
    for row, text in rows.select("row", "text").toLocalIterator():
        if held and size + len(text) > block_bytes:
            yield held
            held, size = [], 0
        held.append((row, bytes(text)))
        size += len(text)
    if held:
        yield held


class Items:
    """A block of items: its vocabulary, and each item's terms as numbers of it."""

    def __init__(self, block: list[tuple[int, bytes]]):
        vocabulary: dict[bytes, int] = {}
        self.rows = [row for row, _ in block]
        self.terms = [np.array(sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text)}), np.int64)
                      for _, text in block]
        self.vocabulary = vocabulary


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored (doc_id, n, terms, counts) of the documents with terms: n of all terms, counts of those in the vocabulary."""
    rows = common.ids_and_texts(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value.get
        for batch in batches:
            ids, sizes, bounds, terms, counts = [], [], [0], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_buffer().to_pybytes())
                if not words:
                    continue
                held = Counter(map(number, words))
                held.pop(None, None)
                ids.append(doc_id)
                sizes.append(len(words))
                terms.extend(held.keys())
                counts.extend(held.values())
                bounds.append(len(terms))
            offsets = pa.array(bounds, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))], ["doc_id", "n", "terms", "counts"])

    return materialize(rows.mapInArrow(of, "doc_id long, n long, terms array<int>, counts array<int>"), "search-vectors")


class Best:
    """The ``top`` highest documents per item that one task has seen: by score, then having an id, then lowest id."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.found = [(np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))] * items
        self.threshold = np.zeros(items, np.int64)

    def offer(self, item: int, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        scores, missing, ids = [np.concatenate(pair) for pair in zip(self.found[item], (scores, missing, ids))]
        if len(scores) > self.top:
            kept = np.lexsort((ids, missing, -scores))[:self.top]
            scores, missing, ids = scores[kept], missing[kept], ids[kept]
        self.found[item] = scores, missing, ids
        if len(scores) == self.top:
            self.threshold[item] = scores.min()


def search_shard(ids: np.ndarray, missing: np.ndarray, bounds: np.ndarray, terms: np.ndarray, impacts: np.ndarray,
                 items: list[np.ndarray], width: int, best: Best, bucket: int = BUCKET) -> None:
    """Offer ``best`` what the shard's vectors hold for the items. Vector k lies at bounds[k]:bounds[k + 1]."""
    square = impacts.astype(np.float64) ** 2
    owner = np.repeat(np.arange(len(ids)), np.diff(bounds))
    length = np.sqrt(np.bincount(owner, square, len(ids)))
    by_length = np.argsort(-length, kind="stable")
    by_length = by_length[length[by_length] > 0]
    place = np.full(len(ids), -1, np.int64)
    place[by_length] = np.arange(len(by_length))
    spot = place[owner]
    real = (spot >= 0) & (impacts > 0)
    # One inverted list per (bucket, term): the postings by bucket, then term, then vector.
    spot, terms, impacts, square = spot[real], terms[real], impacts[real], square[real]
    cell = spot // bucket * width + terms
    order = np.argsort(cell, kind="stable")
    spot, terms, impacts, square, cell = spot[order], terms[order], impacts[order], square[order], cell[order]
    norms = np.array([math.sqrt(len(t)) for t in items])
    alive = np.array([len(t) > 0 for t in items], bool)
    for number in range(-(-len(by_length) // bucket)):
        start = number * bucket
        members = by_length[start:start + bucket]
        lengths = length[members]
        alive &= norms * lengths[0] * SLACK >= best.threshold  # later buckets are no longer
        if not alive.any():
            break
        low, high = np.searchsorted(cell, (number * width, (number + 1) * width))
        at, of = spot[low:high] - start, terms[low:high]
        value, squared = impacts[low:high], square[low:high]
        first = np.searchsorted(of, np.arange(width + 1))
        highest = np.zeros(width, np.int64)
        held = np.flatnonzero(np.diff(first))
        if len(held):
            highest[held] = np.maximum.reduceat(value, first[held])
        for item in np.flatnonzero(alive):
            wanted = items[item][highest[items[item]] > 0]
            bound = highest[wanted]
            threshold = best.threshold[item]
            if bound.sum() < max(threshold, 1):
                continue
            falling = np.argsort(-bound)
            wanted, bound = wanted[falling], bound[falling]
            rest = np.cumsum(bound[::-1])[::-1]  # rest[k]: what terms k and on can add at most
            taken = int(np.count_nonzero(rest >= max(threshold, 1)))
            score = np.zeros(len(members), np.int64)
            seen = np.zeros(len(members))
            for term in wanted[:taken]:
                part = slice(first[term], first[term + 1])
                score[at[part]] += value[part]
                if taken < len(wanted):
                    seen[at[part]] += squared[part]
            near = np.flatnonzero(score)
            if taken < len(wanted):
                left = len(items[item]) - taken
                more = np.sqrt(np.maximum(lengths[near] ** 2 * SLACK - seen[near], 0.0) * left)
                most = score[near] + np.minimum(more, float(rest[taken])) * SLACK + 1
                near = near[most >= threshold]
                if not len(near):
                    continue
                exact = np.zeros(len(members), np.int64)
                chosen = np.zeros(len(members), bool)
                chosen[near] = True
                for term in wanted[taken:]:
                    part = slice(first[term], first[term + 1])
                    on = chosen[at[part]]
                    exact[at[part][on]] += value[part][on]
                score = score + exact
            near = near[score[near] >= max(threshold, 1)]
            if len(near):
                best.offer(item, score[near], missing[members[near]], ids[members[near]])


def _search_block(stored: DataFrame, items: Items, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(row, doc_id, score): each task's highest documents for the items of a block."""
    width = max(1, len(items.vocabulary))
    df = np.zeros(width, np.int64)
    for term, n in stored.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        df[term] = n
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    sent = stored.sparkSession.sparkContext.broadcast((items.rows, items.terms, weight))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, wanted, weight = sent.value
        best = Best(len(rows), top)
        for batch in batches:
            lists, counts = batch.column(2), batch.column(3)
            bounds = np.asarray(lists.offsets).astype(np.int64)
            terms = np.asarray(lists.values)[bounds[0]:bounds[-1]].astype(np.int64)
            tf = np.asarray(counts.values)[np.asarray(counts.offsets)[0]:np.asarray(counts.offsets)[-1]].astype(np.int64)
            ids = batch.column(0)
            missing = np.asarray(ids.is_null())
            ids = np.asarray(ids.fill_null(0))
            n = np.asarray(batch.column(1)).astype(np.int64)
            m = 100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_terms
            m = np.repeat(m, np.diff(bounds))
            impacts = weight[terms] * (1_000_000_000 * tf // (1000 * tf + SATURATION * m))
            search_shard(ids, missing, bounds - bounds[0], terms, impacts, wanted, len(weight), best)
        for row, (scores, missing, ids) in zip(rows, best.found):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(ids), pa.int64()), pa.array(ids, mask=missing), pa.array(scores)],
                    ["row", "doc_id", "score"])

    return stored.mapInArrow(of, "row long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``top`` documents with a score above 0 for each item: (item_id, rank, doc_id, score).

    Terms are maximal runs of letters, digits and characters from U+0080 on,
    A-Z lower-cased. Equal scores go by ascending id, a null id last; a
    repeated document counts and ranks again, and each item row has a ranking
    of its own, also one without an id or with the id of another. Null and
    empty texts have no terms: such documents don't count, such items and
    items no document answers have no rows; neither has an empty table. Other
    columns are not read. How items fall into blocks changes nothing.
    """
    rows = materialize(items.select(
        F.monotonically_increasing_id().alias("row"), items[item_col].alias("item_id"),
        F.coalesce(items[item_text_col].cast("string"), F.lit("")).cast("binary").alias("text")), "search-items")
    found = docs.sparkSession.createDataFrame([], "row long, doc_id long, score long")
    totals = None
    for block in item_blocks(rows, block_bytes):
        wanted = Items(block)
        stored = vectors(docs, wanted.vocabulary, id_col, text_col)
        totals = totals or stored.agg(F.count("*"), F.sum("n")).first()
        if not totals[0]:
            break
        part = _search_block(stored, wanted, int(totals[0]), int(totals[1]), top)
        found = found.unionByName(materialize(part, "search-found"))
    place = F.row_number().over(W.partitionBy("row").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    best = found.withColumn("rank", place).filter(F.col("rank") <= top)
    return best.join(rows.select("row", "item_id"), "row").select("item_id", F.col("rank").cast("int").alias("rank"),
                                                                  "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


OP12_SQL = """
WITH d AS (
    SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
i AS (
    SELECT DISTINCT item_id, item, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT *, row_number() OVER () AS item FROM benchmark)),
t AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
p AS (
    SELECT doc, term, count(*)::BIGINT AS tf FROM (SELECT doc, unnest(terms) AS term FROM d)
    WHERE term IN (SELECT term FROM i) GROUP BY doc, term),
w AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM p, t GROUP BY term, n_docs),
m AS (SELECT doc, doc_id, 100 - 50 + (50 * len(terms)::BIGINT * n_docs) // n_terms AS m FROM d, t WHERE len(terms) > 0),
s AS (
    SELECT item_id, item, m.doc_id, m.doc, sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * m.m)))::BIGINT AS score
    FROM i JOIN p ON p.term = i.term JOIN w ON w.term = i.term JOIN m ON m.doc = p.doc
    GROUP BY item_id, item, m.doc_id, m.doc)
SELECT item_id, (row_number() OVER r)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0
WINDOW r AS (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)
QUALIFY row_number() OVER r <= 50
"""
