"""A bounded sample of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents of each class that a classifier is fitted on at most.
PER_CLASS = 2000


def held_out(doc_id):
    """True for the fifth of documents whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, text, y): at most per_class documents of each label, those whose ids have the smallest hashes.

    Documents of the held-out fifth and labels other than 0 and 1 never enter. Only this sample, of a size that is
    fixed by per_class, is joined to the documents and may be gathered.
    """
    usable = labels.select("doc_id", F.col("quality").alias("y")).where(F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y"))
    picked = [usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))


def keep_rows(docs: DataFrame, decide) -> DataFrame:
    """The rows of docs, all columns, whose text decide(arrow string column) -> boolean numpy array accepts. One map.

    decide gets null texts as nulls; repeated rows are decided each; columns of any name go through; an empty table gives no rows.
    """
    import pyarrow as pa

    from .runs import tidy
    from .words import slices

    @tidy
    def choose(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for a, b in slices(texts):
                kept = batch.slice(a, b - a).filter(pa.array(decide(texts[a:b])))
                if kept.num_rows:
                    yield kept

    return docs.mapInArrow(choose, docs.schema)
