"""Parts of the operators against brute force: every label path of a chain, a plain loop of the network, long texts."""

import itertools
import math
import re
import time
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kickledger.llm import exact_dedup, quality, secrets, simhash, token_store, toxicity

DOCS = "doc_id long, text string"


# --- the chain of lines ------------------------------------------------------------
@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_marginals_are_sums_over_all_label_paths(n):
    rng = np.random.default_rng(n)
    scores, moves = rng.normal(0, 2, n), rng.normal(0, 1, (2, 2))
    good, crossed, total = np.zeros(n), np.zeros((2, 2)), 0.0
    for path in itertools.product((0, 1), repeat=n):
        weight = math.exp(sum(s for s, y in zip(scores, path) if y) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += weight
        good += weight * np.array(path)
        for a, b in zip(path, path[1:]):
            crossed[a, b] += weight
    log_marginal, expected = quality.forward_backward(scores, moves, np.array([n]))
    assert np.allclose(np.exp(log_marginal[:, 1]), good / total) and np.allclose(expected, crossed / total)
    assert np.allclose(quality.long_chain(scores, moves), good / total)


def test_a_text_of_many_lines_is_one_chain(monkeypatch):
    texts = ["good text here, of words.\n" * k for k in range(1, 9)] + ["$$ %% ## || 99\n" * k for k in range(1, 9)]
    model = quality.train(texts, [1] * 8 + [0] * 8, rounds=40)
    mixed = [("a b c. d\n\n$$$ %% |x|\nfoo bar baz, qux\n" * k).encode() for k in (1, 5, 40)] + [b"", b"\n", b"x" * 5000]
    whole = quality.score_texts(model, mixed)
    for lines in (1, 2, 5, 37):
        monkeypatch.setattr(quality, "CHUNK_LINES", lines)
        monkeypatch.setattr(quality, "CHUNK_BYTES", 60)
        assert np.allclose(quality.score_texts(model, mixed), whole)


def test_ten_million_line_feeds_take_bounded_time():
    model = {"weight": np.linspace(-1, 1, 3 * (quality._CLASSES + 10) + 3), "shift": 0.1, "a": 1.0, "b": 0.0,
             "moves": np.array([[0.5, -0.5], [-0.2, 0.4]])}
    begun = time.process_time()
    assert 0 <= quality.score_texts(model, [b"\n" * (1 << 20)])[0] <= 1
    assert time.process_time() - begun < 15


# --- the network -------------------------------------------------------------------
def plain_logit(net, words):
    """One window, word by word, in plain loops."""
    h = toxicity.HIDDEN
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    xs = []
    for w in words:
        marked = b"\x01" + w + b"\x02"
        chars = np.mean([net["chars"][((a * 961 + b * 31 + c) * 2654435761 >> 7) & (toxicity.TRIGRAMS - 1)]
                         for a, b, c in zip(marked, marked[1:], marked[2:])], 0)
        xs.append([*net["words"][net["vocabulary"].get(w, toxicity.UNKNOWN)], *chars])
    sides = []
    for side, order in ((0, range(len(xs))), (1, range(len(xs) - 1, -1, -1))):
        state, out = [0.0] * h, [None] * len(xs)
        for t in order:
            given = [sum(xs[t][k] * net["in"][side, k, g] for k in range(len(xs[t]))) + net["bias"][side, g] for g in range(3 * h)]
            z = [sigmoid(given[j] + sum(state[k] * net["rec"][side, k, j] for k in range(h))) for j in range(h)]
            r = [sigmoid(given[h + j] + sum(state[k] * net["rec"][side, k, h + j] for k in range(h))) for j in range(h)]
            c = [math.tanh(given[2 * h + j] + sum(r[k] * state[k] * net["rec"][side, k, 2 * h + j] for k in range(h)))
                 for j in range(h)]
            state = [z[j] * state[j] + (1 - z[j]) * c[j] for j in range(h)]
            out[t] = state
        sides.append(out)
    seen = [f + b for f, b in zip(*sides)]
    looks = [[math.tanh(sum(s[i] * net["look"][i, j] for i in range(2 * h))) for j in range(2 * h)] for s in seen]
    pull = [math.exp(sum(a * b for a, b in zip(look, net["want"]))) for look in looks]
    pooled = [sum(p * s[j] for p, s in zip(pull, seen)) / sum(pull) for j in range(2 * h)]
    return sum(a * b for a, b in zip(pooled, net["out"])) + net["base"][0]


def test_the_network_is_its_plain_loop():
    rng = random.Random(1)
    vocabulary = [f"word{k}" for k in range(40)] + ["été", "x"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 60))) for _ in range(60)]
    net = toxicity.train(texts, [int("word3 " in t + " ") for t in texts], steps=12)
    cases = texts[:6] + ["word1", "unseen words ONLY here", "WORD3, word3; x"] + [" ".join(vocabulary * 2)]
    got = toxicity.score_texts(net, [t.encode() for t in cases], {})
    for text, score in zip(cases, got):
        words = toxicity.words_of(text.encode())
        windows = [words[k:k + toxicity.WINDOW] for k in toxicity.window_starts(len(words)).tolist()]
        assert score == pytest.approx(1 / (1 + math.exp(-max(plain_logit(net, w) for w in windows))), abs=2e-5)


@pytest.mark.parametrize("name", ["in", "bias", "words", "chars"])
def test_gradients_of_the_inputs(name):
    """The chain rule from gate inputs to parameters, as ``train`` applies it, against differences."""
    rng = np.random.default_rng(2)
    size, h = toxicity.WORD_SIZE + toxicity.CHAR_SIZE, toxicity.HIDDEN
    net = {"vocabulary": {b"one": 2, b"two": 3}, "words": rng.normal(0, 1, (4, toxicity.WORD_SIZE)),
           "chars": rng.normal(0, 1, (toxicity.TRIGRAMS, toxicity.CHAR_SIZE)), "in": rng.normal(0, 0.3, (2, size, 3 * h)),
           "bias": rng.normal(0, 0.3, (2, 3 * h)), "rec": rng.normal(0, 0.3, (2, h, 3 * h)),
           "look": rng.normal(0, 0.3, (2 * h,) * 2), "want": rng.normal(0, 1, 2 * h), "out": rng.normal(0, 1, 2 * h),
           "base": np.zeros(1)}
    words, rows = [b"one", b"two", b"three"], np.array([2, 3, toxicity.UNKNOWN])
    index = np.zeros((2, toxicity.WINDOW), np.int64)
    index[0, :5], index[1, :3] = [1, 2, 3, 1, 1], [3, 3, 2]

    def logits():
        x = toxicity.inputs(net, words, rows).astype(np.float64)
        table = toxicity.gates(net, x)
        return toxicity.forward(net, table, index, keep=True), x, table

    kept, x, table = logits()
    slope = np.array([0.7, -0.3])
    _, d_table = toxicity.backward(net, table.astype(np.float64), index, slope, kept)
    d_gates = d_table[1:]
    d_x = np.einsum("ndg,dkg->nk", d_gates, net["in"])
    codes, sizes = toxicity.trigram_rows(words)
    grads = {"in": np.einsum("nk,ndg->dkg", x, d_gates), "bias": d_gates.sum(0), "words": np.zeros_like(net["words"]),
             "chars": np.zeros_like(net["chars"])}
    np.add.at(grads["words"], rows, d_x[:, :toxicity.WORD_SIZE])
    np.add.at(grads["chars"], codes, np.repeat(d_x[:, toxicity.WORD_SIZE:] / sizes[:, None], sizes, axis=0))
    spots = [(2, 1), (3, 0), (1, 4)] if name == "words" else [(int(codes[0]), 0), (int(codes[-1]), 3)] if name == "chars" \
        else [(0, 3, 2), (1, size - 1, 2 * h)] if name == "in" else [(0, 1), (1, 3 * h - 1)]
    for spot in spots:
        old, sums = net[name][spot], []
        for step in (2e-2, -2e-2):
            net[name][spot] = old + step
            sums.append((logits()[0][0] * slope).sum())
        net[name][spot] = old
        assert grads[name][spot] == pytest.approx((sums[0] - sums[1]) / 4e-2, rel=0.05, abs=2e-4)


# --- secrets -----------------------------------------------------------------------
def test_places_of_very_many_matches(spark):
    rng = random.Random(5)
    digests = " ".join("%032x" % rng.getrandbits(128) + rng.choice(["", ",", "é", "\U0001F600"]) for _ in range(16_000))
    docs = spark.createDataFrame([(1, digests), (2, "deadbeefdeadbeef" + "x" * 9)], DOCS).repartition(2)
    small = docs.filter("doc_id = 2").select(secrets.base_spans(F.col("text"))).collect()
    assert [tuple(s) for s in small[0][0]] == [(0, 2, 16)]
    begun = time.perf_counter()
    spans = docs.filter("doc_id = 1").select(secrets.base_spans(F.col("text")).alias("s"), secrets._matches(
        secrets.uncovered(F.col("text")), secrets.RUN).alias("r")).first()
    assert time.perf_counter() - begun < 20    # the quadratic form took over a minute
    assert [(s.start, s.end) for s in spans.s] == [m.span() for m in re.finditer("[0-9a-f]{16,}", digests)]
    assert spans.r == []


def test_uncovered_text_keeps_places(spark):
    rng = random.Random(6)
    parts = ["token=", "AKIA", "A1B2C3D4E5F6G7H8", "deadbeef01", "secret: ", " ", "x9Kq72LmPzRt5WvB8nYcQ4", "é", "\U0010F041",
             "\U0010F030", "/", "=", "Z", "0123456789abcdef", "\n", '"']
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(800)]
    rows = spark.createDataFrame(list(enumerate(texts)), DOCS).select("text", secrets.base_spans(F.col("text")).alias("base"),
                                                                     secrets._matches(secrets.uncovered(F.col("text")), secrets.RUN).alias("r"))
    for row in rows.collect():
        covered = {k for s in row.base for k in range(s.start, s.end)}
        rest = "".join(" " if k in covered else c for k, c in enumerate(row.text))
        assert [(s.start, s.end, s.found) for s in row.r] == [(*m.span(), m[0]) for m in re.finditer(secrets.RUN, rest)]


def _words(rng, n):
    parts = "get user name value list parse config thread handler buffer index service remote update config item".split()
    return ["".join(rng.choice(parts).title() for _ in range(4)) if k % 2 else "_".join(rng.choice(parts) for _ in range(4))
            for k in range(n)]


def test_recall_and_precision_of_added_spans(spark):
    rng = random.Random(7)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    keys = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(20, 44))) for _ in range(400)]
    names = _words(rng, 400)
    train = [(k, " ".join(_words(rng, 30))) for k in range(300)]
    docs = spark.createDataFrame([(1000 + k, f"see {key} and {name} here") for k, (key, name) in enumerate(zip(keys, names))], DOCS)
    model = secrets.train(secrets.sample_from(spark.createDataFrame(train, DOCS)))
    got = {r.doc_id - 1000: [(s.start, s.end) for s in r.added] for r in secrets.scan(docs, model).collect()}
    caught = sum((4, 4 + len(key)) in got[k] for k, key in enumerate(keys))
    wrong = sum(len(s) for s in got.values()) - caught
    print(f"recall {caught / 400:.3f}, precision {caught / max(1, caught + wrong):.3f}")
    assert caught >= 380 and wrong <= 20


def test_no_ordinary_words_add_no_spans(spark):
    name = "thisIsAnOrdinaryIdentifierName another_ordinary_identifier_name x9Kq72LmPzRt5WvB8nYcQ4"
    for rows in ([(1, "token=abcdefghijklmnop " + name)], [(None, "some ordinary words here " + name)] * 50, []):
        docs = spark.createDataFrame(rows, DOCS)
        assert all(r.added == [] for r in secrets.scan(docs, secrets.train(secrets.sample_from(docs))).collect())


def test_rows_without_an_id_do_not_fill_the_sample(spark):
    rng = random.Random(8)
    docs = spark.createDataFrame([(None, "none")] * 9000 + [(k, " ".join(_words(rng, 20))) for k in range(40)], DOCS)
    model = secrets.train(secrets.sample_from(docs))
    found = secrets.scan(spark.createDataFrame([(1, "getUserNameValueList x9Kq72LmPzRt5WvB8nYcQ4")], DOCS), model).first()
    assert [(s.start, s.end) for s in found.added] == [(21, 43)]


# --- near and exact copies, the pipeline's stages -----------------------------------
def test_any_long_is_an_id(spark):
    ids = [(1 << 62) + 1, (1 << 62) + 2, (1 << 63) - 1, -(1 << 63), -1, 0, None, None]
    rows = [(ids[0], "one text of words"), (ids[1], "one text of words"), (ids[2], "two"), (ids[3], "two"), (ids[4], "three x"),
            (ids[5], "three x"), (None, "no id a"), (None, "no id a"), (None, "one text of words")]
    got = sorted(map(repr, ((r.doc_id, r.component_id) for r in simhash.near_dedup(spark.createDataFrame(rows, DOCS)).collect())))
    assert got == sorted(map(repr, [(ids[0], ids[0]), (ids[1], ids[0]), (None, ids[0]), (ids[2], ids[3]), (ids[3], ids[3]),
                                    (-1, -1), (0, -1), (None, None), (None, None)]))


def test_a_fingerprint_of_very_many_rows(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_ROWS", 5)
    rows = [(k, "hot text of words") for k in range(60, 0, -1)] + [(100 + k, f"other text {k} words") for k in range(20)]
    got = {r.doc_id: r.component_id for r in simhash.near_dedup(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(got) == 80 and {got[k] for k in range(1, 61)} == {1}
    assert simhash.free_bits(3) == 20


def test_stages_keep_columns_named_like_helpers(spark):
    rows = [(1, "a b c d", "keep1", "k2", "x", "y"), (2, "a b c d", "keep3", "k4", "x", "y"), (1, "a b c d", "keep1", "k2", "x", "y"),
            (None, "zz yy", "k", "k", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __sha string, __id string, doc string, `a.b` string")
    out = corpus_pipeline.exact_dedup_stage(spark, docs, "")
    assert out.columns == docs.columns and sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [rows[1], rows[3]]))
    near = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert near.columns == docs.columns and sorted(map(repr, map(tuple, near.collect()))) == sorted(map(repr, [rows[0], rows[3]]))


def test_runs_merge_without_a_further_exchange(spark):
    docs = spark.createDataFrame([(k, f"text {k % 7}") for k in range(200)], DOCS)
    rows = exact_dedup.digests(docs, 8)
    merged = exact_dedup.tree_merge(rows, 8, 8, "largest")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.count("Sort [") == 2 and "HashAggregate" not in plan
    assert sorted((r.stays.doc_id, r.n) for r in merged.collect()) == [(k, sum(j % 7 == k % 7 for j in range(200)))
                                                                      for k in range(193, 200)]


# --- token ids -----------------------------------------------------------------------
def test_units_are_those_of_the_library(monkeypatch):
    from tokenizers import Tokenizer

    with open(token_store.default_tokenizer(), encoding="utf-8") as f:
        text = f.read()
    library = Tokenizer.from_str(text)
    parts = ["a", "B", "é", "1", "²", "'", "'s", "'re", "'ll", "'d", "'t", "don't", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x85",
             "\xa0", " ", "日", "е", "\U0001F600", "́", ".", ",", "--", "%%%", "_", "ª", "½", " the", "<|endoftext|>",
             "\x00", "\x1f", "\x7f", "ɐ", "​", "\xad", "''", "’s"]
    rng = random.Random(11)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 14))) for _ in range(6000)]
    monkeypatch.setattr(token_store, "KNOWN_UNITS", 900)   # the table forgets again and again
    encoder = token_store.UnitEncoder(text, {})
    for at in range(0, len(texts), 501):
        part = texts[at:at + 501]
        ids, sizes = encoder.encode(part, 2)
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [e.ids + [2] for e in library.encode_batch(part, add_special_tokens=False)]
    assert len(encoder.known["at"]) < 3000
    empty, none = encoder.encode(["", ""], 2), encoder.encode([], 2)
    assert empty[0].tolist() == [2, 2] and empty[1].tolist() == [1, 1] and len(none[0]) == len(none[1]) == 0
