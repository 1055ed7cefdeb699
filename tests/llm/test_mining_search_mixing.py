"""Collocations, lexical search and mixing against plain Python, over small tables with edge rows."""

import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from kickledger.llm import collocations, common, lexical, mixing, registry
from tests.conftest import SF_SMOKE

DDL = "doc_id long, text string, lang string, source string, phrase string, row string, n long"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@pytest.fixture(scope="module")
def docs(spark):
    """The smoke documents with edge rows, and columns named like the operators' own."""
    edges = [(None, None, None, None), (None, "a b c", None, None), (7_000_001, "", "en", ""), (7_000_002, " \t\n\x0b", "x\ty", " "),
             (7_000_003, "Der der DER. der, der; der", "de", "src1"), (7_000_004, "no stop " * 4000, "en", "src0"),
             (7_000_005, "É é é 日本 日本 日本! a\rb", None, "日"), (7_000_005, "É é é 日本 日本 日本! a\rb", None, "日"),
             (-(1 << 63), "same text here", "en", "alike"), ((1 << 63) - 1, "one-two one_two ONE;two", "EN", "Z")]
    edges += [(7_000_006, "same row of words again", "en", "alike")] * 40
    edges += [(8_000_000 + k, "x y z. p q", "xx", "two") for k in range(25)]
    more = spark.createDataFrame([(i, t, g, s, "z", "z", 1) for i, t, g, s in edges], DDL)
    return common.table(spark, SF_SMOKE, "documents").select("doc_id", "text", "lang", "source").unionByName(
        more, allowMissingColumns=True)


@pytest.fixture(scope="module")
def rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]


# --- collocations ------------------------------------------------------------------
def pieces_of(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
        if words := re.findall(r"[^\x20\x09]+", piece):
            yield words


def plain_counts(rows, longest):
    f, n = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for k in range(len(words) - size + 1):
                    f[lang, tuple(words[k:k + size])] += 1
    return f, n


def plain_collocations(rows, longest, least, share, top):
    f, n = plain_counts(rows, longest)
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    gone = set()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for k in range(len(words) - size + 1):
                if 100 * a >= share * candidates[lang, words[k:k + size]]:
                    gone.add((lang, words[k:k + size]))
    found = defaultdict(list)
    for (lang, words), a in candidates.items():
        if (lang, words) not in gone:
            score, _, l, r = min((1000000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]],
                                  f[lang, words[k:]]) for k in range(1, len(words)))
            found[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return sorted((lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for lang, of in found.items()
                  for k, (s, a, p, l, r) in enumerate(sorted(of)[:top]))


@pytest.mark.parametrize("longest,least,share,top", [(3, 10, 50, 2000), (2, 2, 50, 10), (4, 3, 80, 50), (6, 5, 1, 2000)])
def test_collocations_are_those_of_plain_counts(docs, rows, longest, least, share, top):
    got = collocations.collocations(docs, longest, least, share, top)
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, longest, least, share, top)


def test_chunks_and_windows_change_no_count(docs, rows, monkeypatch):
    """Tiny chunks, and windows of few words inside them, as very long texts of very many words need."""
    f, n = plain_counts(rows, 3)
    want = {(lang, " ".join(p)): c for (lang, p), c in f.items()} | {(lang, ""): c for lang, c in n.items()}
    cases = [b"a b c a b c\nd a", b"a", b"a b\na b c d e f g h", b"\n\n  \n", b"x " * 50]
    for chunk in cases:
        ids, piece, words = collocations.words_of(chunk)
        whole = Counter()
        for batch in collocations._rows("en", chunk, 3):
            for node, last, c in zip(*batch.to_pydict().values()):
                whole[node, last] += c
        words = [w for p in chunk.split(b"\n") if (w := p.split())]
        assert whole["en\t", None] == sum(map(len, words))
        for k in range(3):
            plain = Counter()
            for p in words:
                for at in range(len(p) - k):
                    plain[b" ".join(p[at:at + k + 1]).decode()] += 1
            flow = Counter()
            for (node, last), c in whole.items():
                phrase = node.split("\t")[1]
                if k == 2 and last is not None:
                    flow[f"{phrase} {last}"] += c
                elif k < 2 and phrase.count(" ") == k and phrase:
                    flow[phrase] += c
            assert flow == plain
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 50)
    found = collocations.phrases(docs, 3, 1)
    assert {(r.lang, r.phrase): r.f for r in found.collect()} == want


def test_windows_of_a_chunk_too_wide_for_one_code(monkeypatch):
    """2 ** 62 codes hold few words of twelve; the windows overlap so that no phrase is lost or counted twice."""
    words = [f"w{k % 40}" for k in range(700)]
    chunk = " ".join(words).encode()
    got = Counter()
    for batch in collocations._rows("en", chunk, 12):
        for node, last, n in zip(*batch.to_pydict().values()):
            got[node, last] += n
    edges = Counter(("en\t" + " ".join(words[k:k + 11]), words[k + 11]) for k in range(len(words) - 11))
    assert {k: v for k, v in got.items() if k[1] is not None} == edges and got["en\t", None] == 700


def test_paths_are_the_unary_runs_of_the_graph(spark):
    texts = ["a b c d e f g h"] * 4 + ["q b c d"] * 3 + ["f g z"] * 2 + ["r r r r r r"] * 2
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    found = collocations.phrases(docs, 3, 2)
    got = {r.phrase: (r.first, r.offset, r.inner_from, r.inner_to) for r in collocations.paths(found, 3).collect()}
    assert got["d e f"] == ("c d e", 1, True, True) and got["c d e"] == ("c d e", 0, False, True)
    assert got["e f g"] == ("c d e", 2, True, False) and got["f g h"][:2] == ("f g h", 0)
    assert got["b c d"] == ("b c d", 0, False, False)  # two edges enter b c
    assert got["r r r"] == ("r r r", 0, False, False)  # a circle that a piece begins in
    f = {r.phrase: r.f for r in found.collect()}
    for phrase, (_, _, inner_from, inner_to) in got.items():
        assert (f[phrase] == f[phrase.rsplit(" ", 1)[0]]) >= inner_from and (f[phrase] == f[phrase.split(" ", 1)[1]]) >= inner_to


def test_long_paths_take_few_rounds_and_scores_are_exact(spark):
    text = " ".join(f"w{k}" for k in range(700))
    docs = spark.createDataFrame([(k, text, "en") for k in range(12)], "doc_id long, text string, lang string")
    path = collocations.paths(collocations.phrases(docs, 3, 10), 3)
    assert path.select("first").distinct().count() == 1 and path.agg(F.max("offset")).first()[0] == 697
    top = collocations.collocations(docs, top=5).collect()
    assert [(r.phrase, r.a, r.l, r.r, r.score) for r in top[:2]] == [
        ("w0 w1 w2", 12, 12, 12, 1_000_000), ("w1 w2 w3", 12, 12, 12, 1_000_000)]
    big = spark.createDataFrame([(3_000_000_000,)], "a long").selectExpr(
        "CAST(CAST(a AS DECIMAL(19,0)) * CAST(a AS DECIMAL(19,0)) AS DECIMAL(31,0)) * 1000000BD AS up",
        "CAST(a AS DECIMAL(19,0)) * CAST(a + 1 AS DECIMAL(19,0)) AS down")
    assert big.selectExpr("up div down AS s").first().s == 1000000 * 3_000_000_000 ** 2 // (3_000_000_000 * 3_000_000_001)


# --- lexical search ------------------------------------------------------------------
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_ranking(rows, items, top):
    split = [(i, TERM.findall(lowered(t))) for i, t, *_ in rows if t is not None]
    split = [(i, Counter(w), len(w)) for i, w in split if w]
    n_docs, n_terms = len(split), sum(n for *_, n in split)
    df = Counter(t for _, tf, _ in split for t in tf)
    out = []
    for item, text in items:
        found = []
        for doc_id, tf, n in split:
            m = 100 - 50 + 50 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 20 * m))
                        for t in set(TERM.findall(lowered(text or ""))) if t in tf)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:top])]
    return out


@pytest.fixture(scope="module")
def items(spark):
    more = spark.createDataFrame([(901, "same row, of WORDS; again"), (902, None), (903, "?! --"), (None, "日本 é stop"),
                                  (904, "x y z"), (904, "p q"), (905, "nowhereatall")], "item_id long, text string")
    return common.table(spark, SF_SMOKE, "benchmark").unionByName(more).withColumn("row", F.lit("z"))


@pytest.mark.parametrize("top,block_bytes", [(50, lexical.BLOCK_BYTES), (3, 700), (1000, 100_000)])
def test_ranking_is_that_of_all_scores(docs, rows, items, top, block_bytes):
    wanted = [tuple(r) for r in items.select("item_id", "text").collect()]
    got = lexical.ranked(docs, items, top, block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain_ranking(rows, wanted, top)))


@pytest.mark.parametrize("seed", range(6))
def test_buckets_prune_nothing_that_counts(seed):
    """Random impact vectors, with ties and equal vectors; buckets of few vectors, so that bounds bite."""
    rng = np.random.default_rng(seed)
    n, width, top = 400, 30, 5
    dense = rng.integers(0, 50, (n, width)) * (rng.random((n, width)) < 0.2) * rng.integers(1, 10 ** int(rng.integers(1, 7)), (n, 1))
    dense[100:200] = dense[rng.integers(0, 20, 100)]
    items = [np.flatnonzero(rng.random(width) < 0.3) for _ in range(12)] + [np.empty(0, np.int64)]
    ids, missing = rng.permutation(n) - 50, rng.random(n) < 0.1
    doc, term = np.nonzero(dense + (rng.random((n, width)) < 0.02))  # some impacts of 0 as well
    bounds = np.searchsorted(doc, np.arange(n + 1))
    best = lexical.Best(len(items), top)
    for part in np.array_split(np.arange(n), 3):
        low, high = bounds[part[0]], bounds[part[-1] + 1]
        lexical.search_shard(ids[part], missing[part], bounds[part[0]:part[-1] + 2] - low, term[low:high],
                             dense[doc[low:high], term[low:high]], items, width, best, bucket=16)
    for k, item in enumerate(items):
        scores = dense[:, item].sum(1) if len(item) else np.zeros(n)
        order = np.lexsort((ids, missing, -scores))
        order = order[scores[order] > 0][:top]
        found = sorted(zip((-best.found[k][0]).tolist(), best.found[k][1].tolist(), best.found[k][2].tolist()))
        assert [f[0] for f in found] == (-scores[order]).astype(int).tolist()
        assert found == list(zip((-scores[order]).astype(int).tolist(), missing[order].tolist(), ids[order].tolist()))


# --- mixing --------------------------------------------------------------------------
def plain_mix(rows, weights=(5, 2, 1), budget=Fraction(3, 2), epochs=2):
    size = {}
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _, s in rows]
    for _, s, n in sized:
        size[s] = size.get(s, 0) + n
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    clamped, total = set(), sum(size.values())
    while True:
        rest = budget * total - sum(epochs * size[s] for s in clamped)
        per = rest / max(1, sum(weight[s] for s in order if s not in clamped))
        above = {s for s in order if s not in clamped and per * weight[s] > epochs * size[s]}
        if not above:
            break
        clamped |= above
    return sized, size, {s: Fraction(epochs * size[s]) if s in clamped else per * weight[s] for s in order}


def test_mix_meets_its_targets(docs, rows):
    sized, size, target = plain_mix(rows)
    got = mixing.mix(docs).collect()
    assert sorted(((r.doc_id, r.source, r.size) for r in got), key=repr) == sorted(sized, key=repr)
    taken, whole = Counter(), defaultdict(set)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(float(target[r.source]), rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        whole[r.source] |= {r.taken % r.size != 0} if r.size else set()
    assert {s: taken[s] for s in size} == {s: math.floor(t) for s, t in target.items()}
    for s in size:  # one document of a source at most is repeated in part
        assert sum(1 for r in got if r.source == s and r.size and r.taken % r.size) <= 1
    assert sum(map(math.floor, target.values())) >= 1.5 * sum(size.values()) - len(size)


def test_mix_runs_agree_and_follow_the_seed(docs):
    def run(df, **more):
        return sorted(map(repr, map(tuple, mixing.mix(df, **more).collect())))

    base = run(docs)
    assert run(docs.repartition(7)) == base and run(docs, rows_per_block=2) == base
    assert run(docs, seed=21) != base


def test_mix_of_few_and_odd_sources(spark):
    def mixed(rows, **more):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        return sorted(map(tuple, mixing.mix(df, **more).select("doc_id", "size", "source_size", "target", "taken").collect()))

    assert mixed([(1, None, "a"), (2, " ", None)]) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixed([(1, "a b c d", "s")]) == [(1, 4, 4, 6.0, 6)]
    # The first source wants 5 of 7 shares, more than twice its size; what it can't take goes to the other.
    assert mixed([(1, "a b", "A"), (2, "a b c d e f g h", "b")]) == [(1, 2, 2, 4.0, 4), (2, 8, 8, 11.0, 11)]
    alike = mixed([(5, "a b c", "s")] * 9)
    assert sum(r[4] for r in alike) == 40 and sorted(r[4] for r in alike) == [3] * 4 + [4] + [6] * 4
    with pytest.raises(ValueError):
        mixed([(1, "a", "s")], budget=(5, 2))


def test_copies_of_a_common_row_are_dealt_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES_A_ROW", 7)
    df = spark.createDataFrame([(5, "a b c", "s")] * 50 + [(None, "a", "s")] * 30, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert len(got) == 80 and sum(r.taken for r in got) == 270 and sum(r.size for r in got) == 180


def test_queries_equal_their_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    assert {n.split("_")[0] for n in registry.ORACLES} == {"op2", "op5", "op11", "op12", "op13"}
    for name, sql in registry.ORACLES.items():
        got, want = registry.QUERIES[name](spark, SF_SMOKE), con.execute(sql)
        names = [c[0] for c in want.description]
        assert got.columns == names
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


def test_empty_tables(spark, docs, items):
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0
    assert lexical.ranked(docs.limit(0), items).count() == 0 and lexical.ranked(docs, items.limit(0)).count() == 0


def test_sources_are_numbered_over_many_ranges(spark):
    names = [f"s{k * 7919 % 1000:04d}" for k in range(1000)] + ["", "é", "\U0001F600", "￿", None]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        found = mixing.numbered(spark.createDataFrame([(n,) for n in names], "source string").repartition(5))
        got = {r.source: r.place for r in found.collect()}
        assert spark.read.parquet(*found.inputFiles()).select("range").distinct().count() > 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    order = sorted((n for n in names if n is not None), key=lambda n: n.encode()) + [None]
    assert got == {n: k for k, n in enumerate(order)}


def test_water_filling_of_very_many_sources(spark):
    rows = [(f"s{k:05d}", int(3 ** (k % 17)), 1) for k in range(300)]
    sized = spark.createDataFrame(rows, "source string, source_size long, weight long")
    got = {r.source: (r.target, r.wanted) for r in mixing.water_fill(sized).collect()}
    total, caps = sum(s for _, s, _ in rows), {n: 2 * s for n, s, _ in rows}
    clamped = set()
    while True:
        share = (Fraction(3, 2) * total - sum(caps[n] for n in clamped)) / (len(rows) - len(clamped))
        above = {n for n in caps if n not in clamped and share > caps[n]}
        if not above:
            break
        clamped |= above
    assert got == {n: (float(caps[n]), caps[n]) if n in clamped else (float(share), math.floor(share)) for n in caps}
    assert len(clamped) > 100 and sum(t for t, _ in got.values()) == pytest.approx(1.5 * total)
