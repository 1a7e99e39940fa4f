"""A corpus pipeline out of the operators of ``screenwright.llm``.

STAGES are applied to ``documents`` in order; each gets the rows that its
predecessor kept.  All but the last return the columns of ``documents``.

1.  toxicity: documents with a score of 0.7 or more go.
2.  near_duplicates: one document of each group (five-word shingles, similarity
    0.8) stays; an id with several texts is a document for each text.
3.  decontamination: documents that match a benchmark item go.
4.  mixing: the mix of the sources, a row for each epoch in which a document is
    taken.
5.  sharding: the mix in shuffled order, in 16 shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenwright.llm import decontamination, mixing, neardup, sharding, toxicity
from screenwright.llm.tables import table
from screenwright.storage import materialize


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that score below the threshold.

    Null, empty and wordless texts have the base score and stay; rows are judged
    by their text alone, so repeated rows and ids, null ids and further columns
    of any name or type pass by; without labels every row stays; an empty table
    gives no rows.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.accepted(docs, labels)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest (id, text hash) of each group of near copies.

    Texts without words and rows with a null id stay; rows equal in id and text
    are one, that with the smallest hash of the other columns; columns may have
    any name or type (maps too); an empty table gives no rows.
    """
    return neardup.deduplicated(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose text matches no benchmark item, each judged by its own text whatever its id.

    Null and empty texts match nothing; further columns pass by; an empty table
    or benchmark changes nothing.
    """
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each epoch in which the mix takes a document; the last one of a source may be cut where its target is reached.

    A null source is a source of its own, last in order; null, empty and wordless
    texts are never taken; rows equal in id, source and text are interchangeable;
    further columns pass by; an empty table gives no rows.
    """
    return mixing.mixed_documents(docs, mixing.mix(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in a shuffled order, with ``shard`` (0 to 15) and ``slot``; columns of these names give way.

    Nulls, repeated rows (a slot each), very long texts and columns of any type
    are carried along; an empty table gives no rows.
    """
    return sharding.shards(docs, 16)


STAGES = [
    ("toxicity", keep_clean),
    ("near_duplicates", keep_distinct),
    ("decontamination", keep_uncontaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: SQL can't express the learned scores of the first stage; tests/llm holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
