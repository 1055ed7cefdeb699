"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its own vector (words of the training vocabulary) joined to
the mean vector of its character trigrams. Windows of ``WINDOW`` words start
every ``STRIDE`` words, so they overlap and cover the whole text. In each,
forward and backward GRUs read the words, attention pools their states, and
a logistic unit gives the window's score; a text scores as its worst window.

Training follows the same rule: in each epoch a text is represented by the
window the current network finds worst (and its gradient flows there), since
a long toxic text may hold one insult.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .labelled import sample

WINDOW, STRIDE = 32, 16
HIDDEN, WORD_SIZE, CHAR_SIZE = 8, 12, 8
TRIGRAMS = 4096
VOCABULARY = 20_000      # words with vectors of their own, at most
SAMPLE_ROWS = 6000       # labelled documents the network is trained on, at most
SAMPLE_CHARS = 8000      # the longest of them
STEPS = 420              # gradient steps, in epochs over the sample
BATCH = 64
CHUNK_WORDS = 150_000    # words scored at once in a task
KNOWN_WORDS = 200_000    # words a worker remembers
HELD_OUT = (4, 2)        # ids with crc32 % 4 == 2 are never learned from

# Words are runs of letters, digits and bytes from 0x80, A-Z lowered; every other byte parts them.
_CODES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))
PAD, UNKNOWN = 0, 1      # rows of the word table


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_CODES).split()


def window_starts(n: int) -> np.ndarray:
    """At least one window; each after the first brings new words."""
    return np.arange(max(1, -(-(n - WINDOW) // STRIDE) + 1)) * STRIDE


def trigram_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed trigrams of all words with a mark at either end, trigrams per word)."""
    data = np.frombuffer(b"".join(b"\x01" + w + b"\x02" for w in words), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    codes = (data[:-2] * 961 + data[1:-1] * 31 + data[2:]) * 2654435761 >> 7 & (TRIGRAMS - 1)
    heads = np.cumsum(sizes + 2) - sizes - 2
    return codes[np.arange(sizes.sum()) + np.repeat(heads - (np.cumsum(sizes) - sizes), sizes)], sizes


def inputs(net: dict, words: list[bytes], rows: np.ndarray) -> np.ndarray:
    """Input vectors of words with the given rows of the word table."""
    codes, sizes = trigram_rows(words)
    chars = np.add.reduceat(net["chars"][codes], np.cumsum(sizes) - sizes, dtype=np.float32) / sizes[:, None]
    return np.concatenate([net["words"][rows], chars], 1).astype(np.float32)


def gates(net: dict, x: np.ndarray) -> np.ndarray:
    """What an input adds to update, reset and candidate, forward then backward; row 0 is padding.

    Padding holds the update gate open, so the state passes unchanged.
    """
    pad = np.zeros((1, 2, 3 * HIDDEN), np.float32)
    pad[:, :, :HIDDEN] = 40
    return np.concatenate([pad, np.einsum("nk,dkg->ndg", x, net["in"]) + net["bias"]])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(net: dict, table: np.ndarray, index: np.ndarray, keep: bool = False):
    """Logits of windows: ``index`` (windows, WINDOW) into the rows of ``table`` (0: padding)."""
    n, h = len(index), HIDDEN
    both = np.stack([index, index[:, ::-1]])
    state = np.zeros((2, n, h), np.float32)
    states, trace = np.empty((2, WINDOW, n, h), np.float32), []
    for t in range(WINDOW):
        given = np.stack([table[both[0, :, t], 0], table[both[1, :, t], 1]])
        zr = _sigmoid(given[..., :2 * h] + state @ net["rec"][:, :, :2 * h])
        z, r = zr[..., :h], zr[..., h:]
        cand = np.tanh(given[..., 2 * h:] + (r * state) @ net["rec"][:, :, 2 * h:])
        if keep:
            trace.append((state, z, r, cand))
        state = z * state + (1 - z) * cand
        states[0, t], states[1, WINDOW - 1 - t] = state
    seen = np.concatenate([states[0], states[1]], 2).transpose(1, 0, 2)      # windows, words, 2h
    looked = np.tanh(seen @ net["look"])
    weight = looked @ net["want"] + np.where(index == 0, np.float32(-1e4), np.float32(0))
    weight = np.exp(weight - weight.max(1, keepdims=True))
    weight /= weight.sum(1, keepdims=True)
    pooled = (weight[:, :, None] * seen).sum(1)
    logit = pooled @ net["out"] + net["base"][0]
    return (logit, trace, seen, looked, weight, pooled, both) if keep else logit


def backward(net: dict, table: np.ndarray, index: np.ndarray, slope, kept) -> tuple[dict, np.ndarray]:
    """Gradients of the parameters, and of ``table``, for d loss / d logit = ``slope``."""
    _, trace, seen, looked, weight, pooled, both = kept
    h, g = HIDDEN, {"out": pooled.T @ slope, "base": slope.sum(keepdims=True)}
    d_pooled = slope[:, None] * net["out"]
    d_weight = (seen @ d_pooled[:, :, None])[:, :, 0]
    d_score = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
    g["want"] = np.einsum("nt,nth->h", d_score, looked)
    d_look = d_score[:, :, None] * net["want"] * (1 - looked ** 2)
    g["look"] = np.einsum("nti,ntj->ij", seen, d_look)
    d_seen = weight[:, :, None] * d_pooled[:, None, :] + d_look @ net["look"].T
    g["rec"], d_table = np.zeros_like(net["rec"]), np.zeros_like(table)
    d_state = np.zeros((2, len(index), h), np.float32)
    for t in range(WINDOW - 1, -1, -1):
        d_state = d_state + np.stack([d_seen[:, t, :h], d_seen[:, WINDOW - 1 - t, h:]])
        state, z, r, cand = trace[t]
        d_cand = d_state * (1 - z) * (1 - cand ** 2)
        d_rs = d_cand @ net["rec"][:, :, 2 * h:].transpose(0, 2, 1)
        d_zr = np.concatenate([d_state * (state - cand) * z * (1 - z), d_rs * state * r * (1 - r)], 2)
        g["rec"][:, :, :2 * h] += state.transpose(0, 2, 1) @ d_zr
        g["rec"][:, :, 2 * h:] += (r * state).transpose(0, 2, 1) @ d_cand
        d_state = d_state * z + d_rs * r + d_zr @ net["rec"][:, :, :2 * h].transpose(0, 2, 1)
        given = np.concatenate([d_zr, d_cand], 2)
        for side in (0, 1):
            np.add.at(d_table[:, side], both[side, :, t], given[side])
    return g, d_table


def train(texts: list[str], labels: list[int], steps: int = STEPS, seed: int = 3) -> dict:
    """The network as plain arrays. Without both labels every text scores the share of label 1."""
    share = (sum(labels) + 0.5) / (len(labels) + 1)
    net = {"blank": float(share)}
    if len(set(labels)) < 2:
        return net
    rng = np.random.default_rng(seed)
    split = [words_of(t.encode()) for t in texts]
    y = np.array(labels, np.float32)
    seen, toxic = Counter(), Counter()
    for words, label in zip(split, labels):
        seen.update(set(words))
        toxic.update(set(words) if label else ())
    chosen = [w for w, n in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:VOCABULARY] if n > 2]
    vocabulary = {w: k + 2 for k, w in enumerate(chosen)}
    words = rng.normal(0, 0.1, (len(chosen) + 2, WORD_SIZE))
    odds = [np.log((toxic[w] + 0.5) / (seen[w] - toxic[w] + 0.5) * (1 - share) / share) for w in chosen]
    words[:, 0] = [0, 0, *np.clip(odds, -3, 3)]    # a head start: the word's own log odds in the sample
    size = WORD_SIZE + CHAR_SIZE
    net |= {"vocabulary": vocabulary, "words": words, "chars": rng.normal(0, 0.1, (TRIGRAMS, CHAR_SIZE)),
            "in": rng.normal(0, size ** -0.5, (2, size, 3 * HIDDEN)), "bias": np.zeros((2, 3 * HIDDEN)),
            "rec": rng.normal(0, HIDDEN ** -0.5, (2, HIDDEN, 3 * HIDDEN)), "look": rng.normal(0, 0.25, (2 * HIDDEN,) * 2),
            "want": rng.normal(0, 0.25, 2 * HIDDEN), "out": rng.normal(0, 0.25, 2 * HIDDEN),
            "base": np.array([np.log(share / (1 - share))])}
    net = {k: v.astype(np.float32) if isinstance(v, np.ndarray) else v for k, v in net.items()}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items() if isinstance(v, np.ndarray)}
    known: list[bytes] = sorted({w for ws in split for w in ws}) or [b"-"]
    place = {w: k + 1 for k, w in enumerate(known)}
    rows = np.array([vocabulary.get(w, UNKNOWN) for w in known])
    coded = [np.array([place[w] for w in ws], np.int64) for ws in split]
    index, of = _windows(coded)
    step = 0
    while step < steps:
        table = gates(net, inputs(net, known, rows))
        logits = np.concatenate([forward(net, table, index[at:at + 4096]) for at in range(0, len(index), 4096)])
        worst = _worst(logits, of, len(texts))
        for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
            step += 1
            rows_used, small = np.unique(index[worst[part]], return_inverse=True)
            rows_used, shift = (rows_used[1:], 0) if rows_used[0] == 0 else (rows_used, 1)
            small = small.reshape(len(part), WINDOW) + shift
            batch = [known[k - 1] for k in rows_used] or [b"-"]
            used = rows[rows_used - 1] if len(rows_used) else np.array([UNKNOWN])
            x = inputs(net, batch, used)
            table = gates(net, x)
            kept = forward(net, table, small, keep=True)
            slope = ((_sigmoid(kept[0]) - y[part]) / len(part)).astype(np.float32)
            g, d_table = backward(net, table, small, slope, kept)
            d_gates = d_table[1:]
            g["in"], g["bias"] = np.einsum("nk,ndg->dkg", x, d_gates), d_gates.sum(0)
            d_x = np.einsum("ndg,dkg->nk", d_gates, net["in"])
            g["words"], g["chars"] = np.zeros_like(net["words"]), np.zeros_like(net["chars"])
            np.add.at(g["words"], used, d_x[:, :WORD_SIZE])
            codes, sizes = trigram_rows(batch)
            np.add.at(g["chars"], codes, np.repeat(d_x[:, WORD_SIZE:] / sizes[:, None], sizes, axis=0))
            for name, grad in g.items():
                m, v = moments[name]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                net[name] -= (0.01 * m / (1 - 0.9 ** step) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return net


def _windows(coded: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(word rows of every window, 0 beyond the text; text of every window)."""
    starts = [window_starts(len(c)) for c in coded]
    counts = np.array([len(s) for s in starts])
    lengths = np.array([len(c) for c in coded])
    of = np.repeat(np.arange(len(coded)), counts)
    flat = np.concatenate([*coded, np.zeros(1, np.int64)])
    at = np.concatenate(starts)[:, None] + np.arange(WINDOW)
    heads = np.cumsum(lengths) - lengths
    return np.where(at < lengths[of][:, None], flat[np.minimum(heads[of][:, None] + at, len(flat) - 1)], 0), of


def _worst(logits: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((logits, of))
    return order[np.searchsorted(of[order], np.arange(n), side="right") - 1]


def score_texts(net: dict, texts: list[bytes], known: dict) -> np.ndarray:
    """Probability of label 1 per text. ``known`` remembers words' gate inputs; it starts anew when full."""
    if "words" not in net:
        return np.full(len(texts), net["blank"])
    out = np.full(len(texts), -np.inf, np.float32)
    held: list[tuple[int, list[bytes]]] = []
    size = 0

    def flush() -> None:
        if not known or len(known["at"]) > KNOWN_WORDS:
            known.update(at={}, table=gates(net, np.zeros((0, WORD_SIZE + CHAR_SIZE), np.float32)))
        at = known["at"]
        if fresh := [w for w in {w for _, ws in held for w in ws} if w not in at]:
            rows = np.array([net["vocabulary"].get(w, UNKNOWN) for w in fresh])
            at.update(zip(fresh, range(len(at) + 1, len(at) + 1 + len(fresh))))
            known["table"] = np.concatenate([known["table"], gates(net, inputs(net, fresh, rows))[1:]])
        coded = [np.fromiter(map(at.__getitem__, ws), np.int64, len(ws)) for _, ws in held]
        index, of = _windows(coded)
        text = np.array([k for k, _ in held])[of]
        for s in range(0, len(index), 4096):
            np.maximum.at(out, text[s:s + 4096], forward(net, known["table"], index[s:s + 4096]))

    for k, text in enumerate(texts):
        words = words_of(text)
        for at in range(0, max(1, len(words)), CHUNK_WORDS):      # long texts in parts that overlap as windows do
            held.append((k, words[max(0, at - STRIDE):at + CHUNK_WORDS]))
            size += len(held[-1][1]) + 1
            if size >= CHUNK_WORDS:
                flush()
                held, size = [], 0
    if held:
        flush()
    return _sigmoid(out.astype(np.float64))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, longest: int = SAMPLE_CHARS, usable=None) -> dict:
    return train(*sample(docs, labels, "toxic", rows, longest, usable))


def score(docs: DataFrame, net: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) per row; the network sees texts only. Null and empty texts are one window of padding.

    Repeated rows give a row each with one score, an empty table none.
    """
    rows = common.ids_and_texts(docs, id_col, text_col)
    sent = rows.sparkSession.sparkContext.broadcast(net)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            scores = score_texts(sent.value, [t.as_buffer().to_pybytes() for t in batch.column(1)], known)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return rows.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(of, "doc_id long, score double")


def op3_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    modulus, held = HELD_OUT
    net = fit(docs, labels, usable=common.id_remainder(F.col("doc_id"), modulus) != held)
    return score(docs, net).select(
        "doc_id", (common.id_remainder(F.col("doc_id"), modulus) == held).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))
