"""SentencePiece byte-fallback BPE, encoded by vectorised merge rounds in numpy.

Exactly the library's result, by a different route. A text's symbols lie in
one flat array; words are segments of it (a word starts at a space mark and
no piece crosses one; neither does any piece hold a pair of neighbouring
characters that occurs in no piece, so such pairs part segments too). In a
round every segment takes its best-scoring pair (a segmented minimum), the
leftmost one, all segments at once; the merged symbols are compacted and
segments without a pair leave. In a long segment all leftmost
non-overlapping places of the best pair merge at once, but only where no
pair that this makes would have gone first.

Distinct words are merged once and kept in a bounded per-worker table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MARK = "▁"
CHUNK_WORDS = 200_000      # words worked on at once in a task
KNOWN_WORDS = 300_000      # words a worker remembers
LONG_SEGMENT = 48          # symbols from which a segment merges in several places at once
_NEVER = np.iinfo(np.int32).max


def model_tables(model_file: str) -> dict:
    """Plain arrays of a BPE model: characters, mergeable pairs with their rank, and the bytes of every piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    normal = {model.id_to_piece(i): i for i in range(size)
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
    scores = np.array([model.get_score(i) for i in range(size)])
    char_ids = np.full(0x110000, -1, np.int32)
    for piece, i in normal.items():
        if len(piece) == 1:
            char_ids[ord(piece)] = i
    if any(MARK in piece.lstrip(MARK) for piece in normal) or any(char_ids[ord(c)] < 0 for p in normal for c in p):
        raise ValueError("a model whose pieces cross a space, or hold a character that is no piece, isn't supported")
    pairs = {normal[p[:k]] * size + normal[p[k:]]: i for p, i in normal.items() for k in range(1, len(p))
             if p[:k] in normal and p[k:] in normal}
    keys = np.array(sorted(pairs), np.int64)
    merged = np.array([pairs[k] for k in keys.tolist()], np.int32)
    ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
    near = {ord(a) << 21 | ord(b) for p in normal for a, b in zip(p, p[1:])}
    spelled = [b""] * size
    for i in range(size):
        piece = model.id_to_piece(i)
        spelled[i] = (bytes([int(piece[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i)
                      else " ⁇ ".encode() if model.is_unknown(i) else piece.replace(MARK, " ").encode())
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
    lengths = np.array([len(s) for s in spelled], np.int64)
    return {"size": size, "char_ids": char_ids, "keys": keys, "merged": merged, "ranks": ranks[merged],
            "near": np.array(sorted(near), np.int64), "byte_ids": byte_ids,
            "spelled": np.frombuffer(b"".join(spelled), np.uint8), "lengths": lengths}


def _pairs(t: dict, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank, merged piece) of neighbouring symbols; unmergeable pairs rank last. Unknown characters are negative."""
    key = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * t["size"] + right, -1)
    at = np.minimum(np.searchsorted(t["keys"], key), len(t["keys"]) - 1)
    hit = t["keys"][at] == key
    return np.where(hit, t["ranks"][at], _NEVER), t["merged"][at]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def merge_words(t: dict, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, ids per word) of words that each start with the space mark."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    new = np.zeros(len(points), bool)
    new[np.cumsum(sizes) - sizes] = True
    if len(points) > 1:
        key = points[:-1] << 21 | points[1:]
        at = np.minimum(np.searchsorted(t["near"], key), len(t["near"]) - 1)
        new[1:] |= t["near"][at] != key
    symbols = t["char_ids"][points]
    symbols = np.where(symbols < 0, -1 - points, symbols)
    place = np.arange(len(points))               # where a symbol's first character stood
    segment = np.cumsum(new) - 1
    done = []
    rank, merged = np.full(len(symbols), _NEVER, np.int32), np.zeros(len(symbols), np.int32)
    inner = np.flatnonzero(segment[1:] == segment[:-1])
    rank[inner], merged[inner] = _pairs(t, symbols[inner], symbols[inner + 1])
    while len(symbols):
        heads = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        best = np.minimum.reduceat(rank, heads)
        counts = np.diff(np.append(heads, len(symbols)))
        live = best < _NEVER
        if not live.all():                       # finished segments leave
            keep = np.repeat(live, counts)
            done.append((place[~keep], symbols[~keep]))
            symbols, place, segment, rank, merged = (x[keep] for x in (symbols, place, segment, rank, merged))
            best, counts = best[live], counts[live]
            heads = np.cumsum(counts) - counts
            if not len(symbols):
                break
        at = np.flatnonzero(rank == np.repeat(best, counts))
        of = np.searchsorted(heads, at, side="right") - 1
        first = np.concatenate([[True], of[1:] != of[:-1]])
        chosen = at[first]
        if (counts >= LONG_SEGMENT).any():
            chosen = _several(t, symbols, segment, merged, best, at, of, first, counts)
        symbols[chosen] = merged[chosen]
        left = np.ones(len(symbols), bool)
        left[chosen + 1] = False
        moved = np.cumsum(left) - 1
        symbols, place, segment, rank, merged = (x[left] for x in (symbols, place, segment, rank, merged))
        again = moved[chosen]
        beside = np.zeros(len(symbols), bool)
        beside[again] = True
        beside[again[again > 0] - 1] = True
        again = np.flatnonzero(beside)
        same = np.zeros(len(again), bool)
        inside = again + 1 < len(symbols)
        same[inside] = segment[again[inside]] == segment[again[inside] + 1]
        rank[again] = _NEVER
        again = again[same]
        rank[again], merged[again] = _pairs(t, symbols[again], symbols[again + 1])
    place, symbols = (np.concatenate(x) for x in zip(*done)) if done else (np.empty(0, np.int64),) * 2
    order = np.argsort(place)
    return _with_bytes(t, symbols[order], np.searchsorted(np.cumsum(sizes), place[order], side="right"), len(words))


def _several(t, symbols, segment, merged, best, at, of, first, counts) -> np.ndarray:
    """Places to merge this round: all leftmost non-overlapping ones in long segments where that is safe."""
    run = np.maximum.accumulate(np.where(np.concatenate([[True], (np.diff(at) != 1) | (of[1:] != of[:-1])]),
                                         np.arange(len(at)), 0))
    take = ((np.arange(len(at)) - run) % 2 == 0) & (first | (counts[of] >= LONG_SEGMENT))
    at, of, first = at[take], of[take], first[take]
    after = symbols.copy()
    after[at] = merged[at]
    gone = np.zeros(len(symbols) + 1, bool)
    gone[at + 1] = True
    lower = np.zeros(len(at), bool)
    for step, other in ((-1, after), (2, after), (2, symbols)):   # neighbours, merged and before they merge
        beside = at + step
        if step < 0:
            beside = np.where(gone[np.maximum(beside, 0)], beside - 1, beside)
        ok = (beside >= 0) & (beside < len(symbols))
        ok[ok] = segment[beside[ok]] == segment[at[ok]]
        pair = (other[beside[ok]], after[at[ok]])
        lower[ok] |= _pairs(t, *(pair if step < 0 else pair[::-1]))[0] < best[of[ok]]
    unsafe = np.zeros(len(best), bool)
    unsafe[of[lower]] = True
    return at[first | ~unsafe[of]]


def _with_bytes(t: dict, symbols: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Unknown characters become the byte pieces of their UTF-8."""
    unknown = np.flatnonzero(symbols < 0)
    sizes = np.ones(len(symbols), np.int64)
    spelled = {int(s): t["byte_ids"][list(chr(-1 - int(s)).encode())] for s in np.unique(symbols[unknown])}
    sizes[unknown] = [len(spelled[s]) for s in symbols[unknown].tolist()]
    ids = np.repeat(symbols, sizes).astype(np.int32)
    starts = np.cumsum(sizes) - sizes
    if len(unknown):
        ids[_ranges(starts[unknown], sizes[unknown])] = np.concatenate([spelled[s] for s in symbols[unknown].tolist()])
    return ids, np.bincount(word, weights=sizes, minlength=n_words).astype(np.int64)


_WORDS = re.compile(f"{MARK}+[^{MARK}]*")


def words_of(text: str) -> list[str]:
    """The words of a normalised text, each without its first space mark."""
    if not text:
        return []
    text = text.replace(" ", MARK)
    if MARK * 2 in text or text[0] == MARK:
        return [w[1:] for w in _WORDS.findall(MARK + text)]
    return text.split(MARK)


def encode_words(t: dict, words: list[str], known: dict) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, ids per word). ``known`` remembers words; it starts anew when full."""
    if not known or len(known["at"]) > KNOWN_WORDS:
        known.update(at={}, ids=np.empty(0, np.int32), starts=np.empty(0, np.int64), sizes=np.empty(0, np.int64))
    at = known["at"]
    if fresh := [w for w in set(words) if w not in at]:
        ids, sizes = merge_words(t, [MARK + w for w in fresh])
        at.update(zip(fresh, range(len(at), len(at) + len(fresh))))
        known["starts"] = np.concatenate([known["starts"], np.cumsum(sizes) - sizes + len(known["ids"])])
        known["sizes"] = np.concatenate([known["sizes"], sizes])
        known["ids"] = np.concatenate([known["ids"], ids])
    index = np.fromiter(map(at.__getitem__, words), np.int64, len(words))
    sizes = known["sizes"][index]
    return known["ids"][_ranges(known["starts"][index], sizes)], sizes


def chunks(t: dict, texts: list[str], known: dict) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The ids of texts as (text number, ids) parts in order, some ``CHUNK_WORDS`` words at once."""
    held: list[tuple[int, list[str]]] = []
    size = 0

    def flush() -> list[tuple[int, np.ndarray]]:
        ids, sizes = encode_words(t, [w for _, part in held for w in part], known)
        ends = np.append(0, np.cumsum(sizes))[np.cumsum([len(part) for _, part in held])]
        return [(k, x) for (k, _), x in zip(held, np.split(ids, ends[:-1]))]

    for k, text in enumerate(texts):
        words = words_of(text)
        for at in range(0, len(words), CHUNK_WORDS):
            held.append((k, words[at:at + CHUNK_WORDS]))
            size += len(held[-1][1])
            if size >= CHUNK_WORDS:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def decode_ids(t: dict, ids: np.ndarray, first: bool = True) -> bytes:
    """UTF-8 of ids; ``first``: they begin a text, whose leading space mark is not part of it."""
    starts = np.cumsum(t["lengths"]) - t["lengths"]
    out = t["spelled"][_ranges(starts[ids], t["lengths"][ids])].tobytes() if len(ids) else b""
    return out[1:] if first and out[:1] == b" " else out


def _sent(spark: SparkSession, model_file: str):
    return spark.sparkContext.broadcast(model_tables(model_file))


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) per row, without begin or end ids; null and empty texts have no ids."""
    rows = common.ids_and_texts(docs, id_col, text_col)
    sent = _sent(rows.sparkSession, model_file)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, known = sent.value, common.worker_cache("pieces:" + model_file)
        for batch in batches:
            parts = [p for chunk in chunks(t, batch.column(1).to_pylist(), known) for p in chunk]
            sizes = np.zeros(batch.num_rows, np.int64)
            np.add.at(sizes, [k for k, _ in parts], [len(x) for _, x in parts])
            flat = np.concatenate([np.empty(0, np.int32), *(x for _, x in parts)])
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["doc_id", "ids"])

    return rows.mapInArrow(of, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give an empty text."""
    sent = _sent(encoded.sparkSession, model_file)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_ids(sent.value, np.array(x.as_py() or [], np.int64)).decode("utf-8", "replace")
                     for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(of, "doc_id long, text string")


def digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row: encoded, then decoded from its ids.

    Null texts count as empty: no ids, both digests of the empty string.
    Repeated rows give a row each; an empty table gives none.
    """
    rows = common.ids_and_texts(docs, id_col, text_col)
    sent = _sent(rows.sparkSession, model_file)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, known = sent.value, common.worker_cache("pieces:" + model_file)
        decimal = [str(i) for i in range(t["size"])]
        for batch in batches:
            n = [0] * batch.num_rows
            written, spoken = ([hashlib.sha256() for _ in n] for _ in range(2))
            for chunk in chunks(t, batch.column(1).to_pylist(), known):
                for k, ids in chunk:
                    text = ",".join(map(decimal.__getitem__, ids.tolist()))
                    written[k].update(("," + text if n[k] else text).encode())
                    spoken[k].update(decode_ids(t, ids, first=not n[k]))
                    n[k] += len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array([h.hexdigest() for h in written]),
                 pa.array([h.hexdigest() for h in spoken])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(of, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.table(spark, sf_dir, "documents"), default_model())
