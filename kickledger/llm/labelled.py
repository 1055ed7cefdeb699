"""Bounded samples of labelled documents, for models that are trained on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, longest: int,
           usable: Column | None = None) -> tuple[list[str], list[int]]:
    """Texts and 0/1 labels of at most ``rows`` labelled documents, in order of their id's hash.

    Texts over ``longest`` characters, null labels and null ids are left out;
    ``usable`` (on doc_id) limits the rows labels may be learned from. Only
    ids, at most ``rows`` of them, choose what is read of the documents.
    """
    wanted = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("y"))
    wanted = wanted.filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    if usable is not None:
        wanted = wanted.filter(usable)
    wanted = common.few(wanted, rows, "doc_id", "y")
    texts = common.ids_and_texts(docs).filter(F.length("text") <= longest)
    found = texts.join(F.broadcast(wanted), "doc_id").select("text", "y", "doc_id") \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y", "text").limit(rows).collect()
    return [r["text"] for r in found], [r["y"] for r in found]
