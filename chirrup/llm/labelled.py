"""A bounded sample of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 2000  # labelled rows of each class a model is fitted on, at most


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % of, F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, allowed: Column, per_class: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, y) of at most `per_class` rows of each class, and the class counts among all allowed labels.

    `allowed` is a condition on labels. A doc_id labelled more than once counts
    once, as 1 if any of its labels is; null ids and null labels are left out.
    Rows are chosen by a hash of the id, so reruns agree.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & allowed)
             .groupBy("doc_id").agg(F.max(F.col(target).cast("int")).alias("y")))
    counts = {int(r.y): int(r.n) for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect() if r.y in (0, 1)}
    chosen = [known.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    some = F.broadcast(chosen[0].union(chosen[1]).withColumnRenamed("doc_id", "_id"))  # 2 * per_class short rows at most
    rows = docs.select("doc_id", "text").join(some, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "y")
    # A repeated id brings repeated rows; the sample stays within its bound.
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * per_class), counts
