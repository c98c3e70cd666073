"""A training corpus from raw documents, in stages of the operators in ``wakeline.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import decontam, jaccard, langid, mixing, tokens
from wakeline.llm.queries import END_ID, folder, tokenizer_path
from wakeline.llm.tables import table
from wakeline.sources.staging import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A document is rejected if no language has this share of it.
LEAST_SHARE = 0.5
# Pieces that a worker remembers: fewer than by themselves, after four other stages.
PIECES = 150_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a language: neither ``und`` nor without a main one.

    A row is judged by its text alone, whatever ids rows share and however often they
    repeat. Null and empty texts, and those without a letter, have no language and go. The
    languages are learned from rows with a label; without any, every row goes.
    """
    rows = docs.select(*COLUMNS)
    names, table_of = langid.train(rows.filter(~langid.held_out(F.col("doc_id"))))
    found = langid.with_language(rows, names, table_of)
    return found.filter((F.col("_lang") != "und") & (F.col("_score") >= LEAST_SHARE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of links: that with the smallest id, nulls last.

    Rows have a number of their own, so repeated rows, null ids and ids that texts of
    several groups share are told apart. Texts without words are in no group and stay.
    """
    rows = staged(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = jaccard.linked(rows.select(F.col("_row").alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias("_row"), "component_id").join(rows.select("_row", "doc_id"), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    kept = groups.groupBy("component_id").agg(first.alias("first")).select(F.col("first._row").alias("_row"))
    return rows.join(kept, "_row").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark.

    A row is judged by its text alone, whatever ids rows share and however often they
    repeat. Null and empty texts stay.
    """
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontam.clean(docs.select(*COLUMNS), items)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in whole documents: each as often as its share of words taken, without bias.

    The fraction that is no whole copy decides by a keyed draw whether there is one more;
    a document drawn 0 times goes. Ids repeat for documents of sources that are repeated.
    Rows are counted one by one, whether or not they share an id.
    """
    rows = staged(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    plan = mixing.mix(rows.select("doc_id", "text", "source", "_row"), order=F.col("_row"))
    times = mixing.copies(plan).withColumnRenamed("_order", "_row")
    return (
        rows.join(times, "_row")
        .withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select(*COLUMNS)
    )


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as coded token ids, read back: doc_id, start, n_tokens, ids_crc32.

    Null texts are empty; null ids come first, and repeated rows are documents of their own.
    """
    texts = docs.select("doc_id", "text")
    to = folder(spark, "tokens")
    return tokens.encode_documents(texts, tokenizer_path(), END_ID, to, cached=PIECES)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("token-ID / binary output", token_ids),
]

# Language models and subword tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    to = folder(spark, "pipeline")
    for place, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{to}/{place}")
        docs = spark.read.parquet(f"{to}/{place}")
    return docs
