"""Document quality by a linear-chain conditional random field over lines.

Every line gets features of its bytes and words, and those of the lines
before and after it. The field labels lines good or bad; it is trained in
numpy on a bounded sample, each line taking its document's label. A
document's quality is the mean of its lines' forward-backward marginals,
weighted by line length, mapped to a probability by a logistic fit on the
same sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .labelled import sample

SAMPLE_ROWS = 9000       # labelled documents the model is trained on, at most
SAMPLE_CHARS = 20_000    # the longest of them
ROUNDS = 160
CHUNK_BYTES = 1 << 20
CHUNK_LINES = 20_000     # lines whose features are held at once; a text of more is one chain in blocks
HELD_OUT = (3, 1)        # ids with crc32 % 3 == 1 are never learned from

# Byte classes: other, lower, upper, digit, space, full stop and comma, other sentence marks, bar, symbols, from 0x80.
_CLASS = np.zeros(256, np.int64)
for _k, _bytes in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                             b" \t\r\x0b\x0c", b".,", b"!?;:'\"()-", b"|", b"#$%&*+/<=>@\\^_`{}~[]"]):
    _CLASS[list(_bytes)] = _k + 1
_CLASS[128:] = 9
_CLASSES = 10
_HASH = np.random.default_rng(7).integers(1, 1 << 62, 256, dtype=np.uint64) | np.uint64(1)


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lines per text, bytes per line); a text has a line more than it has line feeds."""
    lines = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    sizes = np.diff(np.append(-1, ends)) - 1
    n = len(sizes)
    line = np.repeat(np.arange(n), sizes + 1)
    kinds = np.bincount(line * _CLASSES + _CLASS[data], minlength=n * _CLASSES).reshape(n, _CLASSES).astype(np.float64)
    kinds[:, 0] -= 1                                            # the line feed itself
    word = (_CLASS[data] != 4) & (data != 10)
    edge = np.diff(np.concatenate([[0], word.astype(np.int8), [0]]))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    per_byte = np.maximum(sizes, 1)[:, None]
    base = np.zeros((n, _CLASSES + 10))
    base[:, :_CLASSES] = kinds / per_byte
    base[:, _CLASSES] = np.log1p(sizes) / 5
    base[:, _CLASSES + 8] = np.log1p(1) / 5      # lines without words, whatever stands beside them
    if len(starts):
        length = stops - starts
        inside = np.repeat(starts, length)
        at = np.flatnonzero(word)
        codes = (_HASH[data[at]] * (2 * (at - inside).astype(np.uint64) + np.uint64(3))) >> np.uint64(7)
        codes = np.add.reduceat(codes, np.cumsum(length) - length)
        of = line[starts]
        words = np.maximum(np.bincount(of, minlength=n), 1)

        def share(flag: np.ndarray, where: np.ndarray) -> np.ndarray:
            return np.bincount(where, weights=flag, minlength=n) / words

        last = _CLASS[data[stops - 1]]
        first = _CLASS[data[starts]]
        for k in (1, 2):
            base[:, _CLASSES + k] = share((codes[k:] == codes[:-k]) & (of[k:] == of[:-k]), of[k:])
        base[:, _CLASSES + 3] = share(last == 8, of)
        base[:, _CLASSES + 4] = share(last == 6, of)
        base[:, _CLASSES + 5] = share(first == 2, of)
        base[:, _CLASSES + 6] = share(length == 1, of)
        base[:, _CLASSES + 7] = np.minimum(share(length, of), 30) / 10
        base[:, _CLASSES + 8] = np.log1p(words) / 5
        base[np.unique(of), _CLASSES + 9] = 1
    text = np.repeat(np.arange(len(texts)), lines)
    same = text[1:] == text[:-1]
    wide = base.shape[1]
    out = np.zeros((n, 3 * wide + 3))
    out[:, :wide], out[:, -1] = base, 1
    out[1:, wide:2 * wide][same] = base[:-1][same]
    out[:-1, 2 * wide:3 * wide][same] = base[1:][same]
    out[1:, -3], out[:-1, -2] = same, same
    return out, lines, sizes


def _steps(lines: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row numbers of the k-th line of every chain that has one, for each k; longest chains first."""
    heads = np.cumsum(lines) - lines
    order = np.argsort(-lines, kind="stable")
    sorted_lines, sorted_heads = lines[order], heads[order]
    many = len(lines) - np.searchsorted(sorted_lines[::-1], np.arange(lines.max(initial=0)), side="right")
    return order, [sorted_heads[:m] + k for k, m in enumerate(many.tolist())]


def forward_backward(scores: np.ndarray, moves: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log marginals of bad and good per line, expected moves).

    ``scores``: a line's log potential for good, that of bad being 0;
    ``moves``: log potentials of (label, next label).
    """
    emit = np.stack([np.zeros(len(scores)), scores], 1)
    ahead, behind = emit.copy(), np.zeros_like(emit)
    _, steps = _steps(lines)
    for before, now in zip(steps, steps[1:]):
        prior = ahead[before[:len(now)]]
        ahead[now] += np.logaddexp(prior[:, :1] + moves[0], prior[:, 1:] + moves[1])
    for now, after in zip(steps[-2::-1], steps[:0:-1]):
        later = emit[after] + behind[after]
        behind[now[:len(after)]] = np.logaddexp(moves[:, 0] + later[:, :1], moves[:, 1] + later[:, 1:])
    both = ahead + behind
    total = np.logaddexp(both[:, :1], both[:, 1:])
    first = np.ones(len(scores) + 1, bool)
    first[1:] = False
    first[np.cumsum(lines)] = True
    nexts = np.flatnonzero(~first[:-1])
    pair = ahead[nexts - 1][:, :, None] + moves + (emit[nexts] + behind[nexts])[:, None, :]
    return both - total, np.exp(pair - total[nexts][:, :, None]).sum(0)


def long_chain(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Marginal of good per line of one chain, as ``forward_backward`` gives it, for chains of any length.

    The chain is cut into about sqrt(n) segments that run side by side, a
    line of each per step: first each segment's product of 2 x 2 matrices,
    then the messages between segments one after the other, then the messages
    inside all segments. Messages are kept as shares, so nothing overflows.
    """
    n = len(scores)
    length = max(1, int(np.ceil(np.sqrt(n))))
    many = -(-n // length)
    top = np.maximum(scores, 0)
    emit = np.ones((many * length, 2))
    emit[:n, 0], emit[:n, 1] = np.exp(-top), np.exp(scores - top)
    emit = emit.reshape(many, length, 2)
    step, still = np.exp(moves - moves.max()), np.eye(2)

    def matrix(j: int) -> np.ndarray:
        """What line j of every segment does to the message before it; beyond the chain, and before its first line, nothing."""
        at = np.where(((np.arange(many) * length + j < n) & (np.arange(many) * length + j > 0))[:, None, None], step, still)
        return at * emit[:, j, None, :]

    whole = np.broadcast_to(still, (many, 2, 2)).copy()
    for j in range(length):
        whole = whole @ matrix(j)
        whole /= whole.max((1, 2), keepdims=True)
    ahead, behind = np.full((many, 2), 0.5), np.full((many, 2), 0.5)
    for k in range(1, many):
        now = ahead[k - 1] @ whole[k - 1]
        ahead[k] = now / now.sum()
    for k in range(many - 2, -1, -1):
        now = whole[k + 1] @ behind[k + 1]
        behind[k] = now / now.sum()
    good, after = np.empty((many, length)), np.empty((many, length))
    for j in range(length):
        ahead = (ahead[:, None, :] @ matrix(j))[:, 0]
        ahead /= ahead.sum(1, keepdims=True)
        good[:, j] = ahead[:, 1]
    for j in range(length - 1, -1, -1):
        after[:, j] = behind[:, 1]
        behind = (matrix(j) @ behind[:, :, None])[:, :, 0]
        behind /= behind.sum(1, keepdims=True)
    good, after = good.ravel()[:n], after.ravel()[:n]
    both = good * after
    return both / (both + (1 - good) * (1 - after))


def _long_logit(model: dict, text: bytes) -> float:
    """``_logits`` of one text of any number of lines: features in blocks of lines, each with its neighbour lines."""
    ends = np.append(np.flatnonzero(np.frombuffer(text, np.uint8) == 10), len(text))
    n = len(ends)
    scores, sizes = np.empty(n), np.diff(np.append(-1, ends)) - 1
    at = 0
    while at < n:
        # As many lines as fit both bounds, one at least.
        stop = int(np.searchsorted(ends, (ends[at - 1] + 1 if at else 0) + CHUNK_BYTES, side="right"))
        stop = min(n, at + CHUNK_LINES, max(stop, at + 1))
        low, high = max(0, at - 1), min(n, stop + 1)
        x, _, _ = line_features([text[ends[low - 1] + 1 if low else 0:ends[high - 1]]])
        scores[at:stop] = x[at - low:stop - low] @ model["weight"] + model["shift"]
        at = stop
    good = long_chain(scores, model["moves"])
    return float(np.clip(np.log((good * (sizes + 1)).sum() + 1e-300) - np.log(((1 - good) * (sizes + 1)).sum() + 1e-300), -30, 30))


def train(texts: list[str], labels: list[int], rounds: int = ROUNDS) -> dict:
    """The model as plain arrays. Without samples of both labels it scores every text by the share of label 1."""
    share = (sum(labels) + 1) / (len(labels) + 2)
    if len(set(labels)) < 2:
        return {"blank": float(share)}
    x, lines, sizes = (np.concatenate(p) for p in zip(*map(line_features, _chunks([t.encode() for t in texts]))))
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-3)
    mean[-1], spread[-1] = 0, 1
    x = (x - mean) / spread
    y_text = np.array(labels)
    y = np.repeat(y_text, lines)
    weight, moves = np.zeros(x.shape[1]), np.zeros((2, 2))
    chain = np.repeat(np.arange(len(lines)), lines)
    same = chain[1:] == chain[:-1]
    seen = np.bincount(y[:-1][same] * 2 + y[1:][same], minlength=4).reshape(2, 2)
    steps = [[np.zeros_like(p), np.zeros_like(p)] for p in (weight, moves)]
    for k in range(1, rounds + 1):
        marginal, expected = forward_backward(x @ weight, moves, lines)
        slopes = (x.T @ (y - np.exp(marginal[:, 1])) / len(y) - 1e-4 * weight, (seen - expected) / len(y) - 1e-3 * moves)
        for p, g, (m, v) in zip((weight, moves), slopes, steps):     # Adam
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-9)
    model = {"weight": weight / spread, "shift": float(-(mean / spread) @ weight), "moves": moves}
    raw = _logits(model, x * spread + mean, lines, sizes)
    a, b = 1.0, 0.0
    for _ in range(50):                                              # Newton's method on two numbers
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -40, 40)))
        g = np.array([(raw * (y_text - p)).sum() - a * 1e-2, (y_text - p).sum()])
        h = p * (1 - p) + 1e-6
        step = np.linalg.solve(np.array([[(raw * raw * h).sum() + 1e-2, (raw * h).sum()], [(raw * h).sum(), h.sum()]]), g)
        a, b = a + np.clip(step[0], -1, 1), b + np.clip(step[1], -1, 1)
    return model | {"a": float(a), "b": float(b)}


def _logits(model: dict, x: np.ndarray, lines: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log odds of the length-weighted mean marginal per text, between -30 and 30."""
    marginal, _ = forward_backward(x @ model["weight"] + model["shift"], model["moves"], lines)
    heads = np.cumsum(lines) - lines
    shares = np.add.reduceat(np.exp(marginal) * (sizes + 1)[:, None], heads)
    return np.clip(np.log(shares[:, 1] + 1e-300) - np.log(shares[:, 0] + 1e-300), -30, 30)


def score_texts(model: dict, texts: list[bytes]) -> np.ndarray:
    """Probability of good quality per text."""
    if "blank" in model or not texts:
        return np.full(len(texts), model.get("blank", 0.0))
    raw = [np.array([_long_logit(model, part[0])]) if len(part) == 1 and part[0].count(b"\n") >= CHUNK_LINES
           else _logits(model, *line_features(part)) for part in _chunks(texts)]
    return 1 / (1 + np.exp(-(model["a"] * np.concatenate(raw) + model["b"])))


def _chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of texts of about ``CHUNK_BYTES`` and at most ``CHUNK_LINES`` lines; a text of more lines by itself."""
    held, size, lines = [], 0, 0
    for text in texts:
        more = text.count(b"\n") + 1
        if held and (size >= CHUNK_BYTES or lines + more > CHUNK_LINES):
            yield held
            held, size, lines = [], 0, 0
        held.append(text)
        size += len(text) + 1
        lines += more
    if held:
        yield held


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, longest: int = SAMPLE_CHARS, usable=None) -> dict:
    return train(*sample(docs, labels, "quality", rows, longest, usable))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) per row; the model sees texts only. Null texts count as empty: one empty line.

    Repeated rows give a row each with one score, an empty table none.
    """
    rows = common.ids_and_texts(docs, id_col, text_col)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(sent.value, [t.as_buffer().to_pybytes() for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return rows.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(of, "doc_id long, score double")


def keep_good(docs: DataFrame, model: dict, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, all columns kept, whose text scores ``least`` or more.

    Null texts score as empty ones and stay null; repeated rows stay or go
    together; an empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(at).cast(pa.binary())]
            yield batch.filter(pa.array(score_texts(sent.value, texts) >= least))

    return docs.mapInArrow(of, docs.schema)


def op7_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    modulus, held = HELD_OUT
    model = fit(docs, labels, usable=common.id_remainder(F.col("doc_id"), modulus) != held)
    return score(docs, model).select(
        "doc_id", (common.id_remainder(F.col("doc_id"), modulus) == held).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
