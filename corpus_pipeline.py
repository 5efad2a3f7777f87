"""The corpus pipeline: from documents to packed training sequences.

Each stage takes the documents that its predecessor kept and works on all of them. All but the last return the columns
of ``documents``. Rows with a NULL text count as empty. Ids may be NULL or repeat: rows are told apart by numbers that
are written once, so of each group exactly one row stays, the one with the smallest doc_id, NULLs last, then row number.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystrata.llm import toxicity
from keystrata.llm.exact_dedup import exact_dedup
from keystrata.llm.ngram_join import ngram_join
from keystrata.llm.packing import pack
from keystrata.llm.suffix_dedup import suffix_dedup
from keystrata.session import small_batches, written


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents, whatever their columns are called, as ``document`` with their ``text``, a ``row`` number, and ``place``.

    By the place the rows of a group are ranked and told apart.
    """
    rows = written(docs.select(F.struct(*docs.columns).alias("document"), F.monotonically_increasing_id().alias("row")), "corpus-pipeline-rows")
    key = F.col("document.doc_id")
    return rows.withColumns({"text": F.col("document.text"), "place": F.struct(key.isNull().alias("no_id"), key.alias("doc_id"), "row")})


def _of(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The documents of the numbered rows at these places."""
    return rows.join(places.select(F.col("place.row").alias("row")), "row", "left_semi").select("document.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; the models learn from the labels of these documents.

    A NULL text is scored as an empty one. Rows with a NULL id or one that repeats are scored each by its own text; only labels of
    ids are learned from. Columns of any name stay.
    """
    small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # The whole row goes along as the id, so that nothing needs to be joined back.
    scored = toxicity.score(docs.select(F.struct(*docs.columns).alias("document")), model, id_column="document", text_column="document.text")
    return scored.filter("predicted = 0").select("document.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal texts: the one with the smallest id.

    NULL and empty texts are one group. Ids that are NULL come last; equal or NULL ids are told apart by row number. Columns
    of any name stay.
    """
    rows = _numbered(docs)
    return _of(rows, exact_dedup(rows, id_column="place").filter("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a Jaccard similarity of 0.8: the one with the smallest id.

    A NULL text or one without words is linked with nothing and stays. Ids that are NULL come last; equal or NULL ids are
    told apart by row number. Columns of any name stay.
    """
    small_batches(spark)
    rows = _numbered(docs)
    return _of(rows, ngram_join(rows, k=5, above=(80, 100), id_column="place").filter("place = component_id"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 200 bytes that stand at more than one place; only whole characters go.

    A NULL text becomes an empty one. Rows are worked on each for itself, so NULL and equal ids do no harm. ``n_chars`` is counted
    anew; other columns of any name stay.
    """
    small_batches(spark)
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    cut = suffix_dedup(docs.select(F.struct(*rest).alias("document"), "text"), whole_characters=True, id_column="document")
    text = F.decode("kept", "UTF-8")
    return cut.select("document.*", text.alias("text"), F.length(text).cast("long").alias("n_chars")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences of 1024.

    A NULL or empty text gives the end id alone. Each row is a document, whatever its id.
    """
    small_batches(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("best-fit packing", pack_sequences),
]

#: SQL states none of it: the first and the last stage are a trained model and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "corpus-pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
