"""Phrase collocation mining over a weighted de Bruijn graph of words.

A node is a phrase of ``longest - 1`` words, an edge a phrase of ``longest``
words from the node it starts with to the node it ends with, its weight the
phrase's occurrences. Edges are counted over chunks of texts in numpy and
added up by source node, so an edge list never holds one row per occurrence.

Counts of shorter phrases are not counted again, they follow from the flow:
a phrase occurs once for each longer phrase it starts, and once for each
piece it ends. Piece ends are rows beside the edges (no last word). Shorter
phrases than a node are derived the same way inside each chunk, where the
flow holds too, and added up with the rest.

A node that one edge enters and one leaves, both as often as the node itself
occurs, is inside a path. Such paths are compacted (by pointer doubling) to
their first edge and an offset: all counts inside are the path's weight, so
only its ends look up other counts, and phrases inside are no candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from . import common

LONGEST = 3
MIN_COUNT = 10
SHARE = 50            # a phrase is dropped where a longer candidate makes up this percentage of it
TOP = 2000
CHUNK_BYTES = 8 << 20
BYTES_PER_PART = 8 << 20
MAX_PARTS = 20_000
RANK_PARTS = 64
_WIDE = "decimal(38,0)"

#: Bytes of a text to bytes of a chunk: letters lower, tab a blank, the marks that end a piece a line feed.
_MAP = bytearray(range(256))
_MAP[0x41:0x5B] = range(0x61, 0x7B)
_MAP[0x09] = 0x20
for _mark in b".,;:!?\n\x0b\x0c\r":
    _MAP[_mark] = 0x0A
_MAP = bytes(_MAP)


def words_of(chunk: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word numbers and piece numbers in order, and the chunk's words sorted by bytes (a word's number is its place)."""
    data = np.frombuffer(chunk, np.uint8)
    line = data == 0x0A
    gap = line | (data == 0x20)
    first = ~gap
    first[1:] &= gap[:-1]
    starts = np.flatnonzero(first)
    inside = ~gap
    ends = np.flatnonzero(inside & np.append(gap[1:], True)) + 1
    piece = np.cumsum(line, dtype=np.int32)[starts]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                  [None, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes())])
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    ids = rank[coded.indices.to_numpy(zero_copy_only=False)] if len(starts) else np.empty(0, np.int64)
    return ids, piece, coded.dictionary.take(pa.array(order))


def _added(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order with the sum of their weights."""
    if not len(codes):
        return codes, weights
    order = np.argsort(codes)
    codes = codes[order]
    heads = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[heads], np.add.reduceat(weights[order], heads)


def graph_of(ids: np.ndarray, piece: np.ndarray, width: int, longest: int, count: int) -> dict[int, tuple]:
    """Edges, piece ends and derived counts of the first ``count`` words on, phrases as codes in base ``width``.

    ``longest`` gives the edges, ``longest - 1`` the phrases of that length
    that end a piece, and each shorter length all its phrases, from the flow
    of the next longer ones plus piece ends.
    """
    n = len(ids)
    stop = np.searchsorted(piece, piece[:count], side="right") - np.arange(count)  # words from here to the piece's end
    codes, at = ids[:count].copy(), {}
    ended = {}
    for length in range(1, longest + 1):
        if length > 1:
            codes = codes * width + ids[np.minimum(np.arange(count) + length - 1, n - 1)]
        whole = stop >= length if length == longest else stop == length
        at[length] = codes[whole]
    for length in range(longest, 0, -1):
        ended[length] = _added(at[length], np.ones(len(at[length]), np.int64))
    graph = {longest: ended[longest]}
    if longest > 1:
        graph[longest - 1] = ended[longest - 1]
        flow = ended[longest]
        for length in range(longest - 1, 0, -1):
            out = _added(flow[0] // width, flow[1])
            flow = _added(np.concatenate([out[0], ended[length][0]]), np.concatenate([out[1], ended[length][1]]))
            if length < longest - 1:
                graph[length] = flow
    return graph


def _rows(lang: str, chunk: bytes, longest: int) -> Iterator[pa.RecordBatch]:
    ids, piece, words = words_of(chunk)
    if not len(ids):
        return
    width = len(words)
    plain = pa.Array.from_buffers(pa.large_string(), width, words.buffers()) if width else words.cast(pa.large_string())
    prefix = pa.scalar(lang + "\t", pa.large_string())
    begun = pc.binary_join_element_wise(prefix, plain, pa.scalar("", pa.large_string()))
    blank = pa.scalar(" ", pa.large_string())
    most = max(longest + 1, int(2 ** (62 / longest)) if width ** longest >= 1 << 62 else len(ids))
    start = 0
    while start < len(ids):
        stop = min(len(ids), start + most)
        core = stop - start if stop == len(ids) else stop - start - (longest - 1)
        part, of = ids[start:stop], piece[start:stop]
        at, own = width, None
        if width ** longest >= 1 << 62:  # few words of a wide chunk: their own, narrower numbers
            own, part = np.unique(part, return_inverse=True)
            at = len(own)
        total = pa.array([core], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang + "\t"], pa.string()), pa.nulls(1, pa.string()), total], ["node", "last", "n"])
        for length, (codes, n) in graph_of(part, of, at, longest, core).items():
            if not len(codes):
                continue
            digits = []
            for _ in range(length):
                codes, digit = np.divmod(codes, at)
                digits.append(pa.array(own[digit] if own is not None else digit))
            digits.reverse()
            last = plain.take(digits.pop()) if length == longest else pa.nulls(len(n), pa.large_string())
            node = begun.take(digits[0]) if digits else pa.array([lang + "\t"] * len(n), pa.large_string())
            for digit in digits[1:]:
                node = pc.binary_join_element_wise(node, plain.take(digit), blank)
            for k in range(0, len(n), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [node.slice(k, 1 << 16).cast(pa.string()), last.slice(k, 1 << 16).cast(pa.string()),
                     pa.array(n[k:k + (1 << 16)], pa.int64())], ["node", "last", "n"])
        start += core


def counted(docs: DataFrame, longest: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows (node, last, n) of the graph, not yet added up over chunks. ``node``: language, tab, words."""
    rows = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_buffer().to_pybytes()
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text)
                while sum(size.values()) >= 4 * CHUNK_BYTES or size.get(lang, 0) >= CHUNK_BYTES:
                    most = max(size, key=size.get)
                    size.pop(most)
                    yield from _rows(most, b"\n".join(held.pop(most)).translate(_MAP), longest)
        for lang in list(held):
            yield from _rows(lang, b"\n".join(held.pop(lang)).translate(_MAP), longest)

    return rows.mapInArrow(of, "node string, last string, n long")


def phrases(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, text_col: str = "text",
            lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, words, f): all phrases of up to ``longest`` words and ``min_count`` occurrences, stored.

    The row of the empty phrase (0 words) holds the number of words of its
    language. Edges are dealt by their source node, so a node's flow is added
    up where its edges are, without a further shuffle; a very frequent node
    sends a row per chunk and following word at most. Rarer phrases are not stored.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(docs[text_col].cast("string")))).first()[0] or 0
    parts = min(MAX_PARTS, max(common.shuffle_width(spark), size // BYTES_PER_PART))
    edges = counted(docs, longest, text_col, lang_col).repartition(int(parts), "node") \
        .groupBy("node", "last").agg(F.sum("n").alias("n"))
    tail = F.substring_index("node", "\t", -1)
    lang = F.col("node").substr(F.lit(1), F.length("node") - F.length(tail) - 1)
    node = W.partitionBy("node")
    flow = edges.withColumn("f", F.sum("n").over(node)).withColumn(
        "leads", F.row_number().over(node.orderBy(F.col("last").asc_nulls_first())) == 1)
    whole = F.col("leads") & ((F.col("f") >= min_count) | (tail == ""))
    edge = F.col("last").isNotNull() & (F.col("n") >= min_count)
    both = flow.filter(whole | edge).select(lang.alias("lang"), F.explode(F.array(
        F.when(whole, F.struct(tail.alias("phrase"), F.col("f").alias("f"))),
        F.when(edge, F.struct(F.concat_ws(" ", tail, "last").alias("phrase"), F.col("n").alias("f"))))).alias("row")) \
        .filter(F.col("row").isNotNull()).select("lang", "row.*")
    words = F.when(F.col("phrase") == "", 0).otherwise(F.length("phrase") - F.length(F.replace(
        "phrase", F.lit(" "), F.lit(""))) + 1)
    return materialize(both.withColumn("words", words), "phrases")


def _all_but_last(phrase: str) -> Column:
    return F.expr(f"substring_index({phrase}, ' ', size(split({phrase}, ' ', -1)) - 1)")


def _all_but_first(phrase: str) -> Column:
    return F.expr(f"substr({phrase}, instr({phrase}, ' ') + 1)")


def paths(found: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, first, offset, inner_from, inner_to) per edge: its path, and which of its nodes are inside it.

    ``first`` is the path's first edge and ``offset`` the number of edges
    before this one; a path of one edge is its own first. The pointers of all
    edges double in length each round, so rounds grow with the logarithm of
    the longest path; each round is stored. A path has an end: a piece that
    runs into a circle enters it at a node that two edges enter.
    """
    edges = found.filter(F.col("words") == longest).select(
        "lang", "phrase", "f", _all_but_last("phrase").alias("from"), _all_but_first("phrase").alias("to"))
    nodes = found.filter(F.col("words") == longest - 1).select("lang", F.col("phrase").alias("node"), "f")
    sole_in = edges.select("lang", F.col("to").alias("node"), "f", F.col("phrase").alias("before"))
    sole_out = edges.select("lang", F.col("from").alias("node"), "f", "phrase")
    links = materialize(nodes.join(sole_in, ["lang", "node", "f"]).join(sole_out, ["lang", "node", "f"])
                        .select("lang", "phrase", "before", "node"), "phrase-links")
    steps = links.select("lang", "phrase", F.col("before").alias("first"), F.lit(1).cast("long").alias("offset"))
    while True:
        further = steps.select("lang", F.col("phrase").alias("first"), F.col("first").alias("earlier"),
                               F.col("offset").alias("more"))
        steps = materialize(steps.join(further, ["lang", "first"], "left").select(
            "lang", "phrase", F.coalesce("earlier", "first").alias("first"),
            (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"),
            F.col("earlier").isNotNull().alias("moved")), "phrase-paths")
        if steps.filter("moved").isEmpty():
            break
        steps = steps.drop("moved")
    ends = links.select("lang", F.col("before").alias("phrase"), F.lit(True).alias("inner_to"))
    return edges.select("lang", "phrase").join(steps, ["lang", "phrase"], "left").join(
        ends, ["lang", "phrase"], "left").select(
        "lang", "phrase", F.coalesce("first", "phrase").alias("first"),
        F.coalesce("offset", F.lit(0).cast("long")).alias("offset"), F.col("first").isNotNull().alias("inner_from"),
        F.coalesce("inner_to", F.lit(False)).alias("inner_to"))


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, share: int = SHARE,
                 top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The first ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    Texts are lower-cased in A-Z and split at ``. , ; : ! ?`` and line ends
    into pieces, pieces at blanks and tabs into words; counts are per
    language, a null one being ``und``, and phrases stay inside a piece. A
    candidate has 2 to ``longest`` words and ``min_count`` occurrences a.
    Each cut gives l and r, the counts of its parts, and the score
    floor(1000000 a a / (l r)); the lowest counts, of equal ones the earliest
    cut. A candidate inside a longer one that makes up ``share`` percent of
    it is dropped. Order: score, a, then the phrase's bytes.

    A null or empty text has no words; repeated rows count again; an empty
    table gives no rows, a language without candidates neither. Columns
    other than text and language are not read. ``longest`` is 2 to 12.
    """
    if not 2 <= longest <= 12 or not 0 < share <= 100:
        raise ValueError("longest must be 2 to 12 and share 1 to 100")
    found = phrases(docs, longest, min_count, text_col, lang_col)
    path = materialize(paths(found, longest), "phrase-places")
    candidates = found.filter(F.col("words") >= 2)
    longer = found.filter(F.col("words") >= 3).select("lang", F.col("f").alias("longer"), F.explode(
        F.array(_all_but_last("phrase"), _all_but_first("phrase"))).alias("phrase"))
    # An occurrence of any longer phrase is one of the next longer ones as well, so these are the highest.
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("f")))
    kept = kept.select("lang", "phrase", "words", F.col("f").alias("a")) \
        .join(path.select("lang", "phrase", "inner_from", "inner_to"), ["lang", "phrase"], "left")

    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    cuts = kept.withColumn("k", cut).withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn(
        "rest", F.expr("substring_index(phrase, ' ', k - words)"))
    # Inside a path a node occurs as often as the path: no look-up.
    known_head = F.col("inner_from") & (F.col("k") == F.col("words") - 1) & (F.col("words") == longest)
    known_rest = F.col("inner_to") & (F.col("k") == 1) & (F.col("words") == longest)
    def side(is_head: bool, part: str, known: Column) -> Column:
        return F.struct(F.lit(is_head).alias("is_head"), F.col(part).alias("part"),
                        F.coalesce(known, F.lit(False)).alias("known"))

    sides = cuts.select("lang", "phrase", "a", "k", F.explode(F.array(
        side(True, "head", known_head), side(False, "rest", known_rest))).alias("side")).select(
        "lang", "phrase", "a", "k", "side.*")
    counts = found.filter(F.col("words").between(1, longest - 1)).select(
        "lang", F.col("phrase").alias("part"), "f")
    met = sides.filter("NOT known").join(counts, ["lang", "part"]).select("lang", "phrase", "a", "k", "is_head", "f") \
        .unionByName(sides.filter("known").select("lang", "phrase", "a", "k", "is_head", F.col("a").alias("f")))
    halves = met.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("is_head"), F.col("f"))).alias("l"), F.max(F.when(~F.col("is_head"), F.col("f"))).alias("r"))
    wide = halves.withColumn("up", F.col("a").cast("decimal(19,0)") * F.col("a").cast("decimal(19,0)")).withColumn(
        "down", (F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")).cast(_WIDE)).withColumn(
        "up", (F.col("up").cast("decimal(31,0)") * F.lit(1000000).cast("decimal(7,0)")).cast(_WIDE))
    scored = wide.withColumn("score", F.expr("up div down")).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("low")).select(
        "lang", "phrase", "a", "low.l", "low.r", "low.score")
    # The best of each part of a language first, so no task receives all candidates of a language.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    scored = scored.withColumn("part", part).withColumn("place", F.row_number().over(
        W.partitionBy("lang", "part").orderBy(*order))).filter(F.col("place") <= top).drop("part", "place")
    place = F.row_number().over(W.partitionBy("lang").orderBy(*order))
    totals = found.filter("words = 0").select("lang", F.col("f").alias("n"))
    return scored.withColumn("rank", place).filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (
    SELECT lang, 1 AS words, unnest(w) AS phrase FROM w
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
    UNION ALL SELECT lang, 3, unnest(list_transform(
        range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
f AS (SELECT lang, words, phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
c AS (
    SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words >= 2 AND f >= 10),
gone AS (
    SELECT DISTINCT b.lang, b.phrase
    FROM c b, (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS inside FROM c WHERE words = 3) t
    WHERE b.lang = t.lang AND b.phrase = t.inside AND 100 * t.a >= 50 * b.a),
k AS (
    SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
    FROM c, (SELECT unnest([1, 2]) AS k)
    WHERE k < words AND NOT EXISTS (SELECT 1 FROM gone WHERE gone.lang = c.lang AND gone.phrase = c.phrase)),
s AS (
    SELECT k.lang, k.phrase, a, k, x.f AS l, y.f AS r, (1000000 * a * a) // (x.f * y.f) AS score
    FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.head JOIN f y ON y.lang = k.lang AND y.phrase = k.rest),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
top AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM low QUALIFY rank <= 2000)
SELECT top.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n,
    score::BIGINT AS score
FROM top JOIN n ON n.lang = top.lang
"""
