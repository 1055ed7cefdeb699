"""Corpus pipeline over ``documents``: five stages, each one operator of ``kickledger.llm``.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickledger.llm import common, decontaminate, exact_dedup, pieces, quality, simhash
from kickledger.session import materialize

#: The stages train a model, hash, or decode; SQL can't express them.
ORACLE_SQL = None


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, id, sha): each row whole in one column, so that no name of its columns can meet a helper's."""
    whole = F.struct(*[docs[f"`{name}`"] for name in docs.columns])
    return docs.select(whole.alias("doc"), docs["doc_id"].cast("long").alias("id"), exact_dedup.same_text().alias("sha"))


def _rows_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs named in ``kept`` (doc_id, text_sha256), one of each: repeated rows leave one.

    Null ids match null ids. Rows meet by both columns, so a common id or a
    common text alone gathers nothing in one place.
    """
    kept = kept.distinct().withColumnsRenamed({"doc_id": "kept_id", "text_sha256": "kept_sha"})
    rows = _keyed(docs)
    met = rows.join(kept, rows["id"].eqNullSafe(kept["kept_id"]) & (rows["sha"] == kept["kept_sha"]), "left_semi")
    return met.select("doc.*")


def _once(docs: DataFrame) -> DataFrame:
    """Docs in which rows of one id and text are rare: repeats beyond the first leave."""
    rows = _keyed(docs)
    if rows.groupBy("id", "sha").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return docs
    return rows.dropDuplicates(["id", "sha"]).select("doc.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model, trained on the labelled ones of them, rejects go.

    Null texts are judged as empty ones; rows alike are judged alike. Without
    labels of both kinds all share one score. An empty table stays empty.
    """
    model = quality.fit(docs, common.table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays.

    Null and empty texts are equal; a row with an id goes before one without;
    of rows alike in id and text one stays. An empty table stays empty.
    """
    kept = exact_dedup.dedup(docs).filter("kept").select("doc_id", "text_sha256")
    return _once(_rows_of(docs, kept))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component, the row with the smallest doc_id stays (and of its texts, the smallest digest).

    Null, empty and blank texts are one component; a row with an id goes
    before one without; of rows alike in id and text one stays. An empty
    table stays empty.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_sha256")).alias("first")
    stays = simhash.near_dedup(docs).groupBy("component").agg(first).select("first.doc_id", "first.text_sha256")
    return _once(_rows_of(docs, materialize(stays, "simhash-kept")))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut from the texts; documents stay, repeated ones and null texts too.

    An empty benchmark cuts nothing; an empty table stays empty.
    """
    return decontaminate.remove(docs, common.table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded, and decoded from its ids.

    A null text counts as empty: no ids. Repeated rows give a row each, an
    empty table none.
    """
    return pieces.digests(docs, pieces.default_model())


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup_stage),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder before the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
