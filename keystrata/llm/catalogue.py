"""Registered queries of this subpackage, each next to its SQL where SQL can state the result."""

from __future__ import annotations

import os

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keystrata.llm import language, lm_scoring, toxicity
from keystrata.llm.byte_bpe import encode
from keystrata.llm.exact_dedup import exact_dedup
from keystrata.llm.licenses import scan_licenses
from keystrata.llm.ngram_join import ngram_join
from keystrata.llm.packing import pack
from keystrata.llm.spelling import group_spellings
from keystrata.llm.suffix_dedup import suffix_dedup
from keystrata.llm.token_counts import count_tokens
from keystrata.llm.topk import top_k
from keystrata.llm.whitening import whiten

QUERIES: dict = {}
ORACLES: dict = {}
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _importable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package, wherever the driver was started."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, *paths]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    _importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


@query(
    """
    select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
      doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
    from documents window w as (partition by coalesce(text, ''))
    """
)
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"), keep="max")


def bucket(n: int) -> Column:
    """Fold of a document by its id; NULL without one."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def held_out(n: int, fold: int) -> Column:
    """Whether a document is in the fold that nothing is learned from; one without an id never trains, so it is."""
    return F.coalesce(bucket(n) == fold, F.lit(True))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    """Fitted on labelled documents outside the held-out fold."""
    return toxicity.fit(docs, labels.filter(bucket(5) != 0))


@query()
def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join(table(spark, folder, "documents"), k=3, above=(90, 100))


@query()
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = toxicity.score(docs, toxicity_model(docs, table(spark, folder, "labels")))
    return found.withColumn("held_out", held_out(5, 0))


@query()
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    found = encode(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), decoded=True)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language.identify(docs, language.fit(docs.filter(bucket(4) != 2)))
    return found.withColumn("held_out", held_out(4, 2))


@query()
def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    found = lm_scoring.score(table(spark, folder, "documents"), bucket(10) != 0)
    return found.withColumn("held_out", ~F.col("trains")).drop("trains")


@query()
def op7_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query()
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


@query(
    """
    with v as (
      select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
      where vec_id is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (
      select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
      from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
    r as (select *, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank from s)
    select query_id, rank, vec_id, score from r where rank <= 5
    """
)
def op9_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


@query()
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    found = pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")


@query()
def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


@query()
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return group_spellings(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    _importable(spark)
    return corpus_pipeline.run(spark, folder)


QUERIES["pipeline"] = pipeline
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
