"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints come from Arrow batches; everything else is DataFrame work on
distinct fingerprints. A node is a fingerprint, so copies never multiply and
ids of documents play no part in linking; the smallest doc_id of a component
is taken at the end.

Covering family for radius r: bit i of 64 gets a nonzero vector m(i) of
r + 1 bits, and table v (v = 1 .. 2**(r+1) - 1) keeps the bits with
<m(i), v> odd. Any r differing bits span at most r dimensions, so some v is
orthogonal to all of them: that table keeps none of the differing bits and
the pair meets there. No pair within the radius is missed.

Buckets are bounded before anything is gathered: buckets of more than
``bucket_rows`` fingerprints are split by a second, independent covering
family (again no pair is missed), and what is still larger is cut into
hash blocks that meet block pair by block pair. Such a bucket's members agree
in all bits that either mask keeps: it holds at most 2**f fingerprints, f
being the bits that neither keeps (``free_bits``: 20 for a radius of three),
however large the corpus. A bucket's members are linked as stars (member to the smallest member it connects to), at most one
edge per member, never all pairs. Components follow by large-star /
small-star rounds over stored edge tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import common

SHINGLE_WORDS = 3
MAX_BITS = 3
BUCKET_ROWS = 256
SEED = 42
HOT_ROWS = 10_000   # a fingerprint of more rows than this, and of a thousandth of all rows, is joined by broadcast
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of UTF-8 text: A-Z lowered, words split at space and \\t..\\r, shingles with repeats."""
    from xxhash import xxh64_intdigest

    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(x) for x in zip(*(words[k:] for k in range(shingle_words)))]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 8192):   # bounded memory for any length
        part = np.array([xxh64_intdigest(s, SEED) for s in shingles[at:at + 8192]], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(shingles), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256, fp long) per row; fp holds the 64 bits as a signed long."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_buffer().to_pybytes(), shingle_words) for t in batch.column(2)),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps.view(np.int64))],
                                             ["doc_id", "text_sha256", "fp"])

    rows = common.ids_and_texts(docs, id_col, text_col)
    return rows.select("doc_id", common.sha256_hex(F.col("text")).alias("text_sha256"),
                       F.col("text").cast("binary").alias("body")).mapInArrow(
        of, "doc_id long, text_sha256 string, fp long")


def covering_masks(radius: int, seed: int) -> list[int]:
    """2**(radius+1) - 1 masks of 64 bits; every set of ``radius`` bits lies outside one of them.

    The vectors m(i) run evenly through all nonzero values, in an order the
    seed shuffles, so that each table keeps about half of the bits.
    """
    top = 1 << (radius + 1)
    vectors = np.resize(np.arange(1, top), 64)
    np.random.default_rng(seed).shuffle(vectors)
    return [sum(1 << i for i in range(64) if bin(int(vectors[i]) & v).count("1") % 2) for v in range(1, top)]


def free_bits(radius: int) -> int:
    """The most bits that a mask of the first family and one of the second both leave out."""
    return max(64 - bin(a | b).count("1") for a in covering_masks(radius, 1) for b in covering_masks(radius, 2))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _tables(fp: Column, radius: int, seed: int) -> Column:
    """array<struct(table, part)>: the fingerprint under each mask."""
    return F.array(*[F.struct(F.lit(t).alias("table"), fp.bitwiseAND(F.lit(_signed(m))).alias("part"))
                     for t, m in enumerate(covering_masks(radius, seed))])


def _stars(max_bits: int):
    """Member lists (node, fp), each of bounded length, to star edges (a > b) inside each list."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column(0)
            lengths = np.diff(members.offsets.to_numpy())
            flat = members.flatten()
            nodes, fps = flat.field(0).to_numpy(), flat.field(1).to_numpy().view(np.uint64)
            starts = members.offsets.to_numpy()[:-1] - members.offsets[0].as_py()
            tops, lows = [], []
            for k in np.unique(lengths):
                at = starts[lengths == k]
                step = max(1, 2_000_000 // int(k * k))
                for s in range(0, len(at), step):      # lists of one length together, bounded memory
                    idx = at[s:s + step, None] + np.arange(k)
                    near = np.bitwise_count(fps[idx][:, :, None] ^ fps[idx][:, None, :]) <= max_bits
                    label = nodes[idx]
                    while True:
                        low = np.where(near, label[:, None, :], np.iinfo(np.int64).max).min(2)
                        if (low == label).all():
                            break
                        label = low
                    moved = label < nodes[idx]
                    tops.append(nodes[idx][moved])
                    lows.append(label[moved])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*tops, np.empty(0, np.int64)])),
                                              pa.array(np.concatenate([*lows, np.empty(0, np.int64)]))], ["a", "b"])
    return of


def _lists(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.collect_list(F.struct("node", "fp")).alias("members")).select("members")


def edges(nodes: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Star edges (a, b), a > b, that connect exactly the nodes (node, fp) connected by links of ``max_bits`` bits."""
    first = ["table", "part"]
    dealt = nodes.select("node", "fp", F.inline(_tables(F.col("fp"), max_bits, seed=1)))
    sizes = dealt.groupBy(*first).agg(F.count("*").alias("n")).filter("n > 1")
    shared = materialize(dealt.join(sizes, first), "simhash-buckets")
    second = [*first, "table2", "part2"]
    split = shared.filter(F.col("n") > bucket_rows).drop("n").select(
        "node", "fp", *first, F.inline(_tables(F.col("fp"), max_bits, seed=2)).alias("table2", "part2"))
    sizes2 = split.groupBy(*second).agg(F.count("*").alias("n")).filter("n > 1")
    again = materialize(split.join(sizes2, second), "simhash-split")
    # Still larger: B hash blocks; block pair (i, j) holds the rows of both, so every two rows meet in one pair.
    blocks = F.ceil(F.col("n") / F.lit(bucket_rows // 2)).cast("int")
    large = again.filter(F.col("n") > bucket_rows).withColumn("blocks", blocks) \
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    lists = _lists(shared.filter(F.col("n") <= bucket_rows), first) \
        .unionByName(_lists(again.filter(F.col("n") <= bucket_rows), second)) \
        .unionByName(_lists(large, [*second, "i", "j"]))
    return lists.mapInArrow(_stars(max_bits), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): for every node with an edge, the smallest node it reaches.

    Large-star and small-star rounds; each round is a stored table, and the
    table that no longer changes is a set of stars around the smallest nodes.
    """
    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = materialize(links.select("a", "b"), "simhash-edges")
    seen = mark(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low2 = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low2, "a")
        now = materialize(small.select("a", F.col("low").alias("b"))
                          .union(small.filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b")))
                          .distinct(), "simhash-edges")
        if (count := mark(now)) == seen:
            return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
        seen = count


def near_dedup(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
               bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256, fp, component, component_id) per row: rows linked at ``max_bits`` differing bits or fewer.

    Links count transitively; ``component`` is the component's smallest
    fingerprint (as a signed long), ``component_id`` its smallest doc_id. Any
    long may be an id.

    Null, empty and blank texts have fingerprint zero and link like any
    other. Repeated rows share a fingerprint. A row without an id links too;
    its component_id is null only where no row of the component has an id.
    An empty table gives no rows.
    """
    rows = materialize(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    nodes = materialize(nodes.withColumn("node", F.col("fp")), "simhash-nodes")
    linked = components(edges(nodes, max_bits, bucket_rows))
    named = nodes.join(linked, "node", "left").select("fp", "least", "n", F.coalesce("component", "fp").alias("component"))
    named = materialize(named, "simhash-components")
    firsts = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.select("fp", "n", "component").join(firsts, "component")
    # Fingerprints of very many rows, fewer than a thousand of them, leave those rows where they are.
    bound = max(HOT_ROWS, int(nodes.agg(F.sum("n")).first()[0] or 0) // 1000)
    hot = F.broadcast(materialize(named.filter(F.col("n") > bound).drop("n"), "simhash-hot"))
    apart = rows.join(hot.select("fp"), "fp", "left_anti").join(named.filter(F.col("n") <= bound).drop("n"), "fp")
    return rows.join(hot, "fp").unionByName(apart).select("doc_id", "text_sha256", "fp", "component", "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
