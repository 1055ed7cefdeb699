"""Secret scanning: fixed patterns plus character Markov models, in built-in expressions only.

Three base patterns (assign, access, hex) find spans by shape. The method
adds spans of kind ``markov``: runs of key-like characters whose characters
follow each other as in random strings rather than as in ordinary
identifiers. Two first-order character models, one per class, are counted
from labelled samples, backing off to single characters; a run's score is the mean log
likelihood ratio of its transitions, and it is a secret where that exceeds a
threshold. The model is a matrix of alphabet x alphabet log ratios (a fixed
size, independent of the corpus), carried as an array literal.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# The base patterns. Group 2 of ASSIGN needs 12 characters.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"   # equals AKIA[A-Z0-9]+ with failing matches of under 18 characters dropped
HEX = r"[0-9a-f]{16,}"          # equals [0-9a-f]+ with failing matches of under 16 characters dropped
KINDS = ["assign", "access", "hex", "markov"]

SHORTEST = 16

# Twins of the characters below 0x80, and the base patterns with a twin allowed for each character.
_TWIN = 0x10F000
PLAIN, TWINS = "".join(map(chr, range(1, 128))), "".join(chr(_TWIN + c) for c in range(1, 128))
TWIN_CLASS = rf"[\x{{{_TWIN:X}}}-\x{{{_TWIN + 127:X}}}]"
HEX_OR_TWIN = (rf"[0-9a-f\x{{{_TWIN + 0x30:X}}}-\x{{{_TWIN + 0x39:X}}}\x{{{_TWIN + 0x61:X}}}-\x{{{_TWIN + 0x66:X}}}]"
               "{16,}")
ACCESS_OR_TWIN = "".join(rf"[{c}\x{{{_TWIN + ord(c):X}}}]" for c in "AKIA") + (
    rf"[A-Z0-9\x{{{_TWIN + 0x41:X}}}-\x{{{_TWIN + 0x5A:X}}}\x{{{_TWIN + 0x30:X}}}-\x{{{_TWIN + 0x39:X}}}]" "{14,}")
BLOCK = 64                      # matches
SPANS = "array<struct<start:int,end:int,found:string>>"

RUN = rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}"  # what the Markov models judge, less base spans
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SIZE = len(ALPHABET) + 1        # the last class is every other character
SAMPLE_DOCS = 8000              # documents the samples are taken from, at most
BACK_OFF = 5.0                  # weight, in counts, of a character's own share against its share after another
FLOOR = 0.05                    # part of that share spread evenly, so that what neither class holds tells nothing
MARGIN = 1.0                    # mean log likelihood ratio per transition, in nats, above which a run is a secret


def _matches(text: Column, pattern: str) -> Column:
    """array<struct(start, end, found)> of all matches, leftmost, non-overlapping; code points, end exclusive.

    ``split`` and ``regexp_extract_all`` walk the same matches, so the k-th
    match starts after k + 1 pieces and k matches.
    """
    def of(both: Column) -> Column:
        # Places are running sums. Appending copies an array, so they are taken inside blocks, then shifted by the
        # blocks before: the work stays near the number of matches, however many a text has.
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(both) - 1) / BLOCK).cast("int")),
                             lambda k: F.slice(both, k * BLOCK + 1, BLOCK))
        inside = F.transform(blocks, lambda block: F.aggregate(
            block, F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out")),
            lambda s, m: F.struct(
                (s["at"] + F.length(m["piece"]) + F.length(m["found"])).alias("at"),
                F.concat(s["out"], F.array(F.struct(
                    (s["at"] + F.length(m["piece"])).alias("start"),
                    (s["at"] + F.length(m["piece"]) + F.length(m["found"])).alias("end"),
                    m["found"].alias("found")))).alias("out"))))
        return _once(inside, shifted)

    def shifted(inside: Column) -> Column:
        firsts = F.aggregate(
            inside, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda s, b: F.struct((s["at"] + b["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
            lambda s: s["out"])
        return _once(firsts, lambda firsts: F.flatten(F.transform(inside, lambda b, k: F.transform(b["out"], lambda m: F.struct(
            (m["start"] + F.get(firsts, k)).alias("start"), (m["end"] + F.get(firsts, k)).alias("end"),
            m["found"].alias("found"))))))

    none = F.array().cast(SPANS)
    return F.when(text.rlike(pattern), _once(_walk(text, pattern), lambda w: F.when(F.size(w["parts"]) > 0, _once(
        w["parts"], of)).otherwise(none))).otherwise(none)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often and however deep inside loops it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _walk(text: Column, pattern: str) -> Column:
    """struct(parts: array<struct(piece, found)>, last): each match with the piece before it, and the piece after all."""
    both = F.struct(F.split(text, pattern, -1).alias("pieces"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    return _once(both, lambda b: F.struct(
        F.transform(b["found"], lambda f, k: F.struct(F.get(b["pieces"], k).alias("piece"), f.alias("found"))).alias("parts"),
        F.element_at(b["pieces"], -1).alias("last")))


def _is_assignment(found: Column) -> Column:
    return F.length(F.regexp_extract(found, ASSIGN, 2)) >= 12


def base_spans(text: Column) -> Column:
    """array<struct(start, end, kind int)> of the base patterns, by start, then kind as listed."""
    assign = F.filter(_matches(text, ASSIGN), lambda m: _is_assignment(m["found"]))

    def of(spans: Column, kind: int) -> Column:
        return F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"),
                                                     m["end"].alias("end")))

    return F.array_sort(F.concat(of(assign, 0), of(_matches(text, ACCESS), 1), of(_matches(text, HEX), 2)))


def _class_of(char: Column) -> Column:
    """Position of a character in the alphabet; every other character shares the last class."""
    at = F.instr(F.lit(ALPHABET), char)
    return F.when(at > 0, at - 1).otherwise(F.lit(SIZE - 1))


def transitions(samples: DataFrame) -> DataFrame:
    """Counts of (label, from, to) over samples (text, label)."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("text") - 1), lambda i: F.substring(F.col("text"), i, F.lit(2)))
    return samples.filter(F.length("text") > 1).select("label", F.explode(pairs).alias("pair")) \
        .groupBy("label", "pair").agg(F.count("*").alias("n")) \
        .select("label", _class_of(F.substring("pair", 1, 1)).alias("a"),
                _class_of(F.substring("pair", 2, 1)).alias("b"), "n") \
        .groupBy("label", "a", "b").agg(F.sum("n").alias("n"))


def train(samples: DataFrame) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary) as a flat SIZE x SIZE list.

    ``samples`` holds (text, label): label 1 a random string, 0 an ordinary
    identifier. At most 2 x SIZE x SIZE counts reach the driver, whatever the
    sample. Where one class has no samples every ratio is 0, so nothing is found.
    """
    counts = {(r["label"], r["a"], r["b"]): r["n"] for r in transitions(samples).collect()}
    if {label for label, _, _ in counts} != {0, 1}:
        return [0.0] * (SIZE * SIZE)
    logs = []
    for label in (0, 1):
        pairs = [[counts.get((label, a, b), 0) for b in range(SIZE)] for a in range(SIZE)]
        total = sum(map(sum, pairs))
        alone = [(1 - FLOOR) * sum(row[b] for row in pairs) / max(1, total) + FLOOR / SIZE for b in range(SIZE)]
        logs.append([math.log((row[b] + BACK_OFF * alone[b]) / (sum(row) + BACK_OFF)) for row in pairs for b in range(SIZE)])
    return [random - ordinary for ordinary, random in zip(*logs)]


def sample_from(docs: DataFrame, limit: int = SAMPLE_DOCS) -> DataFrame:
    """Labelled samples (text, label) of documents: values in secret-shaped spans, and other words.

    Label 1: what the base patterns find (of an assignment, its value), and
    ``limit`` base-64 digests of counters, random by construction, for keys of
    mixed case. Label 0: distinct words of six letters or more of documents
    without such spans. At most ``limit`` documents are used, those with the
    smallest id hashes; documents without an id are not sampled.
    """
    rows = common.ids_and_texts(docs).filter(F.col("doc_id").isNotNull())
    chosen = common.few(rows.select("doc_id"), limit, "doc_id").distinct()
    rows = rows.join(F.broadcast(chosen), "doc_id")
    shaped = F.col("text").rlike(f"{ACCESS}|{HEX}|{ASSIGN}")
    hot, calm = rows.filter(shaped), rows.filter(~shaped)
    value = F.regexp_extract("found", ASSIGN, 2)
    random = hot.select(F.explode(F.concat(*[
        F.transform(_matches(F.col("text"), p), lambda m: m["found"]) for p in (ASSIGN, ACCESS, HEX)])).alias("found")) \
        .select(F.when(value != "", value).otherwise(F.col("found")).alias("text")) \
        .filter(F.length("text") >= 12).distinct().withColumn("label", F.lit(1))
    digests = docs.sparkSession.range(limit).select(
        F.base64(F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256))).alias("text"),
        F.lit(1).alias("label"))
    words = F.regexp_extract_all("text", F.lit(r"[A-Za-z_]{6,}"), F.lit(0))
    ordinary = calm.select(F.explode(words).alias("text")).distinct().withColumn("label", F.lit(0))
    return random.unionByName(digests).unionByName(ordinary)


def score(found: Column, model: list[float]) -> Column:
    """Mean log likelihood ratio per transition of a string of two characters or more."""
    ratios = F.array(*[F.lit(x) for x in model])
    classes = F.transform(F.split(found, ""), _class_of)
    total = F.aggregate(
        classes, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
        lambda s, c: F.struct(c.alias("last"), F.when(s["last"] < 0, F.lit(0.0)).otherwise(
            s["sum"] + F.element_at(ratios, s["last"] * SIZE + c + 1)).alias("sum")),
        lambda s: s["sum"])
    return total / (F.length(found) - 1)


def _veiled(text: Column, pattern: str, covers: Callable[[Column], Column] | None = None) -> Column:
    """Text in which each character of a match (that ``covers``) is replaced by its twin, all others staying in place."""
    def veil(found: Column) -> Column:
        twin = F.translate(found, PLAIN, TWINS)
        return F.when(covers(found), twin).otherwise(found) if covers else twin

    whole = _once(_walk(text, pattern), lambda w: F.concat(F.array_join(F.transform(
        w["parts"], lambda m: F.concat(m["piece"], veil(m["found"]))), ""), w["last"]))
    return F.when(text.rlike(pattern), whole).otherwise(text)


def uncovered(text: Column) -> Column:
    """Text with all characters of base spans veiled: what is left of a run keeps its place and characters.

    Twins are 128 private characters, one per character below 0x80; those a
    text holds itself become a control character first, which no pattern takes. Veiling must not hide a match of
    another base pattern, so those patterns take a twin for its character.
    """
    clean = F.when(text.rlike(TWIN_CLASS), F.regexp_replace(text, TWIN_CLASS, "\u0001")).otherwise(text)
    return _veiled(_veiled(_veiled(clean, ASSIGN, _is_assignment), HEX_OR_TWIN), ACCESS_OR_TWIN)


def scan(docs: DataFrame, model: list[float], margin: float = MARGIN, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, base, added) per document: arrays of struct(start, kind, end).

    ``added`` holds what the Markov models take for random of the runs, less
    what base spans cover of them: each rest of ``SHORTEST`` characters or
    more is judged by itself. Null and empty texts have no spans; repeated
    rows give a row each; an empty table gives none.
    """
    rows = common.ids_and_texts(docs, id_col, text_col)
    based = rows.select("doc_id", "text", base_spans(F.col("text")).alias("base"))
    based = based.select("doc_id", "base", F.when(F.size("base") > 0, uncovered(F.col("text"))).otherwise(
        F.col("text")).alias("rest"))
    based = based.select("doc_id", "base", _matches(F.col("rest"), RUN).alias("rests"))
    fresh = F.filter("rests", lambda r: score(r["found"], model) > margin)
    return based.select("doc_id", "base", F.transform(fresh, lambda r: F.struct(
        r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end"))).alias("added"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = scan(docs, train(sample_from(docs)))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        common.sha256_hex(_joined(F.col("base"))).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_markov"))
