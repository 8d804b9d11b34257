"""A training-data pipeline over documents: language, near duplicates, benchmark leaks, personal data, packing.

Every decision falls on a row, known by a hash of its id and text: null ids and ids that several texts share are judged like
all others. The stages take further columns of any name through as they are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.llm import decontamination, jaccard_join, language_id, packing, pii
from cloakframe.llm.queries import held_out, table
from cloakframe.llm.shared import free_name, materialize, small


def row_key() -> Column:
    """A 64-bit hash of a row's id and text; rows that are equal in both are judged as one."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text)."""
    return docs.select(row_key().alias("row"), "doc_id", "text")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows whose key is in gone (row)."""
    name = free_name(docs, "row_key")
    kept = docs.withColumn(name, row_key()).join(small(gone.withColumnRenamed("row", name)), name, "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language that can be told: no letters or no clear first choice, and a document goes.

    The model learns as in op9, from labelled documents that are not held out."""
    held = free_name(docs, "held")
    rows = docs.withColumn(held, F.coalesce(held_out(), F.lit(False)))
    model = language_id.train(rows.filter(F.col("doc_id").isNotNull() & ~F.col(held)))
    judged = language_id.judged(docs, model, docs.columns)
    return judged.filter((F.col("told.lang_pred") != language_id.UNKNOWN) & ~F.col("told.ambiguous")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked texts (five-word shingles, similarity 0.8) the document with the smallest id.

    Ids that are null come last, equal ids stand in order of a hash of the text, and of rows equal in both one stays. A text
    without words is its own component and stays once."""
    rows = keyed(docs)
    found = jaccard_join.jaccard_components(rows, id_col="row", shingle=5, threshold=80).select(F.col("doc_id").alias("row"), "component_id")
    found = materialize(found, "components")
    several = found.filter("component_id <> row").select("component_id").distinct()
    members = found.distinct().join(small(materialize(several, "groups")), "component_id")
    members = members.join(rows.select("row", "doc_id").distinct(), "row")
    best = members.groupBy("component_id").agg(F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best"))
    best = small(materialize(best, "first-of-group"))  # a large group's members stay where they are
    gone = materialize(members.join(best, "component_id").filter("row <> best").select("row"), "duplicates")
    left = without(docs, gone)
    # rows equal in id and text: few, and only these are shuffled
    again = materialize(rows.groupBy("row").count().filter("count > 1").select("row"), "repeated-rows")
    if again.isEmpty():
        return left
    name = free_name(docs, "row_key")
    twice = left.withColumn(name, row_key()).join(small(again.withColumnRenamed("row", name)), name, "left_semi")
    one = twice.dropDuplicates([name]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return without(left, again).unionByName(one)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontamination.contaminated(keyed(docs), table(spark, sf_dir, "benchmark"), id_col="row")
    return without(docs, materialize(found.select(F.col("doc_id").alias("row")).distinct(), "leaks"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal values under the session's key, and n_chars of the new text."""
    out = pii.pseudonymise(docs, pii.session_key(spark), spans_col=None)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    import public_tokenizers

    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("pii", private_data),
    ("packing", sequences),
]

#: Models, pseudonyms and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what a stage returns is written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
