"""Token ids as canonical length-limited Huffman codes, in blocks that decode on their own.

One pass tokenizes and stores the ids; their global counts (at most one row
per vocabulary entry) give the code lengths, limited to ``MAX_BITS`` by
package-merge; lengths alone fix the canonical codes. Documents are then
range-partitioned by doc_id and sorted, and each partition writes blocks of
whole documents, closed at ``BLOCK_IDS`` ids: their doc_ids and counts, the
packed bits, and the bit offset of every ``LANE_IDS``-th id.

Decoding looks codes up in one table of 2**MAX_BITS entries; the checkpoints
let all lanes of a block advance together, one id each per step.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, shared_path
from . import common

MAX_BITS = 18
BLOCK_IDS = 1 << 17
LANE_IDS = 128
CHUNK_CHARS = 2_000_000
KNOWN_UNITS = 600_000       # units a worker remembers, and bytes of them
KNOWN_BYTES = 16 << 20
JOINED_UNITS = 256
END_ID = 2

# Classes of characters. Where a character's class may depend on the Unicode version it is UNSURE.
OTHER, LETTER, NUMBER, BLANK, SPACE, UNSURE = range(6)
_SURE = 0x250               # below here letters and numbers have not changed for decades


@functools.cache
def _classes() -> np.ndarray:
    table = np.full(0x110000, UNSURE, np.uint8)
    for c in (*range(0x21, 0x7F), *range(0xA1, _SURE)):
        kind = unicodedata.category(chr(c))[0]
        table[c] = LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    table[[9, 10, 13]] = BLANK
    table[32] = SPACE
    return table


def unit_starts(chars: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Which characters begin a unit: the parts that byte-level pre-tokenization encodes one by one.

    A unit is a run of letters, of numbers or of other marks with the space
    before it, a contraction, or white space: of several blanks all but the
    last, which, if it is a space, belongs to what follows. Pre-tokenization
    always parts before a space between two characters that are no blanks;
    where an unsure character stands between two such places, all from one
    to the next is one unit. ``chars`` are the code points of joined texts.
    """
    n = len(chars)
    kind = _classes()[chars]
    first = np.zeros(n + 1, bool)
    first[text_starts] = True
    first = first[:n]
    before = np.empty(n, np.uint8)
    before[0], before[1:] = BLANK, kind[:-1]
    before[first] = BLANK               # a text begins like a line, but see ``joined`` below
    after = np.empty(n, np.uint8)
    after[-1], after[:-1] = BLANK, kind[1:]
    after[np.flatnonzero(first)[1:] - 1] = BLANK
    ends = np.zeros(n, bool)            # last character of its text
    ends[-1], ends[:-1] = True, first[1:]
    white, white_before, white_after = ((k == BLANK) | (k == SPACE) for k in (kind, before, after))
    white_before &= ~first
    joined = np.zeros(n, bool)          # a space stands before it that belongs to it
    joined[1:] = (kind[:-1] == SPACE) & ~white[1:] & ~first[1:]
    start = ~white & ~joined & (white_before | (kind != before))
    # Of a run of blanks: its first, and its last if something follows it.
    start |= white & (~white_before | (~white_after & ~ends))
    start |= first
    quote = np.flatnonzero((chars == 0x27) & start)
    if len(quote):
        wide = np.concatenate([chars, np.zeros(2, chars.dtype)])
        text = np.cumsum(first)
        text = np.concatenate([text, [-1, -1]])
        one, two = wide[quote + 1], wide[quote + 2]
        same, same2 = text[quote + 1] == text[quote], text[quote + 2] == text[quote]
        short = np.isin(one, list(map(ord, "stmd"))) & same
        pair = one.astype(np.int64) << 32 | two
        long = np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]) & same2
        for hit, size in ((short, 2), (long, 3)):
            at = quote[hit]
            for k in range(1, size):
                start[at + k] = False
            at = at[at + size < n] + size
            start[at] = True
    if (kind == UNSURE).any():
        sure = ~white & (kind != UNSURE)
        cut = first.copy()
        cut[1:-1] |= (kind[1:-1] == SPACE) & sure[:-2] & sure[2:] & ~first[1:-1] & ~first[2:]
        places = np.flatnonzero(cut)
        odd = np.logical_or.reduceat(kind == UNSURE, places)
        start &= cut | ~np.repeat(odd, np.diff(np.append(places, n)))
    return start


class UnitEncoder:
    """Encodes texts with the tokenizers library; a unit seen before is taken from a bounded table.

    The table keeps the units that most chunks hold when it is full.
    """

    def __init__(self, tokenizer_json: str, known: dict):
        from tokenizers import Tokenizer

        self.known = known
        if "tokenizer" not in known:
            known["tokenizer"] = tokenizer = Tokenizer.from_str(tokenizer_json)
            vocabulary = tokenizer.get_vocab()
            spaced = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), bool)
            spaced[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
            known.update(spaced=spaced, line=vocabulary.get("Ċ", -1),
                         added=[t.content for t in tokenizer.get_added_tokens_decoder().values()])
        self.tokenizer = known["tokenizer"]

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids with the end id after each text, ids per text)."""
        known = self.known
        whole = "".join(texts)
        chars = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        text_starts = np.cumsum(sizes) - sizes
        if len(chars):
            start = unit_starts(chars, text_starts[sizes > 0])
            if any(token in whole for token in known["added"]):   # such texts are one unit each
                for k, text in enumerate(texts):
                    if any(token in text for token in known["added"]):
                        start[text_starts[k] + 1:text_starts[k] + sizes[k]] = False
            starts = np.flatnonzero(start)
            width = (1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)).astype(np.int64)
            places = np.append(np.cumsum(width) - width, width.sum())
            data = whole.encode()
            units = pa.Array.from_buffers(pa.large_binary(), len(starts), [
                None, pa.py_buffer(places[np.append(starts, len(chars))]), pa.py_buffer(data)]).dictionary_encode()
            numbers = self._numbers(units.dictionary.to_pylist(), end_id)
            index = numbers[units.indices.to_numpy(zero_copy_only=False)]
        else:
            starts, index = np.empty(0, np.int64), np.empty(0, np.int64)
            self._numbers([], end_id)
        # The end id, unit 0 of the table, follows the units of each text.
        index = np.insert(index, np.searchsorted(starts, text_starts + sizes), 0)
        counts = known["sizes"][index]
        ids = known["ids"][_ranges(known["starts"][index], counts)]
        last = np.searchsorted(starts, text_starts + sizes) + np.arange(len(texts))
        return ids, np.diff(np.append(0, np.cumsum(counts)[last])) if len(texts) else np.empty(0, np.int64)

    def _numbers(self, units: list[bytes], end_id: int) -> np.ndarray:
        """Table numbers of distinct units; those not seen before are encoded and added."""
        known = self.known
        if "at" not in known:
            known.update(at={None: 0}, ids=np.array([end_id], np.int32), starts=np.zeros(1, np.int64),
                         sizes=np.ones(1, np.int64), seen=np.full(1, 1 << 40), bytes=0)
        elif len(known["at"]) > KNOWN_UNITS or known["bytes"] > KNOWN_BYTES:
            self._forget()
        at = known["at"]
        numbers = np.fromiter((at.get(u, -1) for u in units), np.int64, len(units))
        fresh = np.flatnonzero(numbers < 0)
        if len(fresh):
            new = [units[k] for k in fresh.tolist()]
            flat, starts, sizes = self._encode_units([u.decode() for u in new])
            numbers[fresh] = np.arange(len(known["sizes"]), len(known["sizes"]) + len(new))
            known["starts"] = np.concatenate([known["starts"], starts + len(known["ids"])])
            known["sizes"] = np.concatenate([known["sizes"], sizes])
            known["ids"] = np.concatenate([known["ids"], flat])
            known["seen"] = np.concatenate([known["seen"], np.zeros(len(new), np.int64)])
            known["bytes"] += sum(map(len, new))
            at.update(zip(new, numbers[fresh].tolist()))
        known["seen"][numbers] += 1
        return numbers

    def _forget(self) -> None:
        """Keep the units that were met in most chunks, a third of the table at most, and none that was met once."""
        known = self.known
        least = max(2, int(np.partition(known["seen"], -(KNOWN_UNITS // 3))[-(KNOWN_UNITS // 3)]) + 1
                    if len(known["seen"]) > KNOWN_UNITS // 3 else 2)
        kept = np.flatnonzero(known["seen"] >= least)
        place = np.full(len(known["seen"]), -1, np.int64)
        place[kept] = np.arange(len(kept))
        known["at"] = {u: p for u, n in known["at"].items() if (p := int(place[n])) >= 0 and (u is None or len(u) < 256)}
        sizes = known["sizes"][kept]
        known["ids"] = known["ids"][_ranges(known["starts"][kept], sizes)]
        known.update(starts=np.cumsum(sizes) - sizes, sizes=sizes, seen=known["seen"][kept] // 2 + 1,
                     bytes=sum(len(u or b"") for u in known["at"]))
        known["seen"][0] = 1 << 40

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where a unit's ids start, how many they are) of distinct units.

        Units that begin with a space are joined, many to a call: only a
        unit's first token begins with a space, so the ids show where the
        next unit begins. Others are joined by line feeds, which are tokens
        of their own. White space and what is unsure is encoded by itself.
        """
        known = self.known
        # Printable and below _SURE: nothing unsure, no line feed; no second space: one run with the space before it.
        kind = [2 if not u.isprintable() or not (u.isascii() or max(u) < chr(_SURE)) or (space := u.rfind(" ")) > 0
                or len(u) <= -~space else 0 if space == 0 else 1 for u in units]
        if known["line"] < 0:
            kind = [2 if x == 1 else x for x in kind]
        groups = [[k for k, x in enumerate(kind) if x == g] for g in range(3)]
        texts = [("" if g == 0 else "\n").join([units[k] for k in groups[g][at:at + JOINED_UNITS]])
                 for g in (0, 1) for at in range(0, len(groups[g]), JOINED_UNITS)]
        texts += [units[k] for k in groups[2]]
        found = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        calls = [-(-len(groups[g]) // JOINED_UNITS) for g in (0, 1)]
        spaced = np.concatenate([np.empty(0, np.int32), *found[:calls[0]]])
        heads = np.flatnonzero(known["spaced"][spaced])
        lined = np.concatenate([np.empty(0, np.int32), *[x for f in found[calls[0]:sum(calls)] for x in (f, [known["line"]])]])
        line = np.flatnonzero(lined == known["line"])
        alone = found[sum(calls):]
        assert len(heads) == len(groups[0]) and len(line) == len(groups[1]), "a tokenizer that joins units isn't supported"
        sizes = np.concatenate([np.diff(np.append(heads, len(spaced))), np.diff(np.append(-1, line)) - 1,
                                np.fromiter(map(len, alone), np.int64, len(alone))]).astype(np.int64)
        flat = np.concatenate([spaced, lined[lined != known["line"]], *alone]).astype(np.int32)
        starts = np.cumsum(sizes) - sizes
        back = np.argsort(np.array([k for g in groups for k in g], np.int64))
        return flat, starts[back], sizes[back]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def tokenize(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, ids binary) per row: little-endian unsigned ids of 16 bits, or of 32 for a larger vocabulary.

    A null text counts as empty: the end id alone. Repeated rows give a row
    each, an empty table none.
    """
    rows = common.ids_and_texts(docs, id_col, text_col)
    with open(tokenizer_file, encoding="utf-8") as f:
        sent = rows.sparkSession.sparkContext.broadcast(f.read())
    kind = _width(tokenizer_file)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # one core per task, as Spark hands them out
        encoder = UnitEncoder(sent.value, common.worker_cache("units:" + tokenizer_file))
        for batch in batches:
            texts, out, at = batch.column(1).to_pylist(), [], 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and size < CHUNK_CHARS:
                    size += len(texts[end])
                    end += 1
                ids, sizes = encoder.encode(texts[at:end], end_id)
                out += [x.astype(kind).tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])]
                at = end
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "ids"])

    return rows.mapInArrow(of, "doc_id long, ids binary")


def _width(tokenizer_file: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer_file).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def counts(stored: DataFrame, kind: str) -> DataFrame:
    """(id, n) over all stored ids; each task sends one row per id it holds."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for x in batch.column(0):
                found = np.bincount(np.frombuffer(x.as_buffer(), kind))
                if len(found) > len(total):
                    total = np.pad(total, (0, len(found) - len(total)))
                total[:len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    return stored.select("ids").mapInArrow(of, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(n: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for symbols with counts ``n`` (0: no code), by package-merge."""
    used = np.flatnonzero(n)
    lengths = np.zeros(len(n), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} symbols need codes of more than {max_bits} bits")
    used = used[np.argsort(n[used], kind="stable")]
    weights = n[used].astype(np.float64)
    levels = []                       # per level: is the k-th cheapest item a symbol (else a package of the level below)
    packages = np.empty(0)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order < len(weights))
        merged = merged[order]
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(used) - 2
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:take].sum())
        lengths[used[:symbols]] += 1
        take = 2 * (take - symbols)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol), each the one before plus one, widened to the new length."""
    codes, code, last = np.zeros(len(lengths), np.int64), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for s in order[lengths[order] > 0].tolist():
        code <<= int(lengths[s]) - last
        codes[s], last = code, int(lengths[s])
        code += 1
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bits, first bit first in each byte; bit offset of every ``LANE_IDS``-th id)."""
    size = lengths[ids]
    at = np.cumsum(size) - size
    total = int(at[-1] + size[-1]) if len(ids) else 0
    word = at >> 5
    wide = codes[ids].astype(np.uint64) << (64 - size - (at & 31)).astype(np.uint64)   # in two words of 32 bits
    out = np.zeros((total >> 5) + 3, np.uint64)
    heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(ids) else np.empty(0, np.int64)
    if len(ids):
        sums = np.add.reduceat(wide, heads)      # codes of one word don't overlap, so their sum is their union
        out[word[heads]] += sums >> np.uint64(32)
        out[word[heads] + 1] += sums & np.uint64(0xFFFFFFFF)
    return out.astype(">u4").tobytes()[:(total + 7) // 8], at[::LANE_IDS]


def decoding_table(lengths: np.ndarray, codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length of the code that the next ``max_bits`` bits begin with."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(codes[used] << (max_bits - lengths[used]), kind="stable")]
    spans = 1 << (max_bits - lengths[order])
    fill = (1 << max_bits) - int(spans.sum())
    return (np.concatenate([np.repeat(order, spans), np.zeros(fill, np.int64)]).astype(np.int32),
            np.concatenate([np.repeat(lengths[order], spans), np.ones(fill, np.int64)]).astype(np.int64))


def unpack(bits: bytes, checkpoints: np.ndarray, n: int, symbols: np.ndarray, sizes: np.ndarray,
           max_bits: int) -> np.ndarray:
    """``n`` ids: every lane starts at its checkpoint and all lanes decode one id per step."""
    padded = np.frombuffer(bits + b"\0" * 8, np.uint8).astype(np.int64)
    window = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]   # 32 bits from every byte
    at = checkpoints.astype(np.int64)
    out = np.zeros((len(at), LANE_IDS), np.int32)
    for k in range(min(LANE_IDS, n)):
        if n - (len(at) - 1) * LANE_IDS <= k and len(at) == len(out):
            at = at[:-1]                         # the last lane may be short
        byte = at >> 3
        ahead = window[byte] >> (32 - max_bits - (at & 7)) & ((1 << max_bits) - 1)
        out[:len(at), k] = symbols[ahead]
        at = at + sizes[ahead]
    return out.ravel()[:n]


_BLOCK = "part int, seq int, first_id long, doc_ids array<long>, doc_counts array<long>, n_ids long, " \
         "checkpoints array<long>, bits binary"


def write(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS,
          max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the token store: ``path/blocks`` in ascending doc_id order and ``path/code`` (id, length).

    Null and empty texts hold the end id alone; rows without an id come
    first; repeated rows are stored each. An empty table makes an empty store.
    """
    if max_bits > 25:
        raise ValueError("codes of more than 25 bits don't fit the decoder's 32-bit window")
    spark = docs.sparkSession
    kind = _width(tokenizer_file)
    stored = materialize(tokenize(docs, tokenizer_file, end_id, id_col, text_col), "token-ids")
    tally = {r["id"]: r["n"] for r in counts(stored, kind).collect()}     # bounded by the vocabulary
    n = np.zeros(max([0, *tally]) + 1, np.int64)
    n[list(tally)] = list(tally.values())
    lengths = code_lengths(n, max_bits)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)] or [(0, 0)],
                          "id long, length int").coalesce(1).write.parquet(f"{path}/code")
    sent = spark.sparkContext.broadcast((lengths, canonical_codes(lengths)))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lengths, codes = sent.value
        part, seq, first, held, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def block() -> pa.RecordBatch:
            nonlocal seq, first, held, size
            ids = np.concatenate([x for _, x in held]).astype(np.int64)
            bits, checkpoints = pack(ids, lengths, codes)
            row = {"part": part, "seq": seq, "first_id": first, "doc_ids": [d for d, _ in held],
                   "doc_counts": [len(x) for _, x in held], "n_ids": len(ids),
                   "checkpoints": checkpoints.tolist(), "bits": bits}
            seq, first, held, size = seq + 1, first + len(ids), [], 0
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("first_id", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("doc_counts", pa.list_(pa.int64())),
                            ("n_ids", pa.int64()), ("checkpoints", pa.list_(pa.int64())), ("bits", pa.binary())])
        for batch in batches:
            for doc_id, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.append((doc_id, np.frombuffer(x.as_buffer(), kind)))
                size += len(held[-1][1])
                if size >= block_ids:
                    yield block()
        if held:
            yield block()

    width = common.shuffle_width(spark)
    ordered = stored.repartitionByRange(width, "doc_id", F.xxhash64("ids")).sortWithinPartitions("doc_id", F.xxhash64("ids"))
    ordered.mapInArrow(of, _BLOCK).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, start long, ids binary) per document, decoded from its block: ids as little-endian unsigned 32-bit.

    ``start``: ids of all documents before it. Blocks decode independently of
    each other; where a partition starts comes from the counts of the
    partitions before it, one row per partition.
    """
    rows = spark.read.parquet(f"{path}/code").collect()
    lengths = np.zeros(max(r["id"] for r in rows) + 1, np.int64)
    for r in rows:
        lengths[r["id"]] = r["length"]
    sent = spark.sparkContext.broadcast(decoding_table(lengths, canonical_codes(lengths), max_bits))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, sizes = sent.value
        for batch in batches:
            for b in range(batch.num_rows):
                part, seq, first, doc_ids, doc_counts, n, checkpoints, bits = (c[b].as_py() for c in batch.columns)
                ids = unpack(bits, np.array(checkpoints), n, symbols, sizes, max_bits).astype("<u4")
                ends = np.cumsum(doc_counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64()), pa.array([part] * len(ends), pa.int32()),
                    pa.array(first + ends - np.array(doc_counts)),
                    pa.array([x.tobytes() for x in np.split(ids, ends[:-1])], pa.binary())],
                    ["doc_id", "part", "in_part", "ids"])

    found = spark.read.parquet(f"{path}/blocks").mapInArrow(of, "doc_id long, part int, in_part long, ids binary")
    return found.join(F.broadcast(starts(spark, path)), "part").select(
        "doc_id", (F.col("in_part") + F.col("before")).alias("start"), "ids")


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, before): ids in all partitions before; one row per partition of the store."""
    parts = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)     # as many rows as partitions
    return parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op6_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-store")
    write(common.table(spark, sf_dir, "documents"), path, default_tokenizer())
    return read(spark, path).select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                                    F.crc32("ids").alias("ids_crc32"))
