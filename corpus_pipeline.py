"""The corpus pipeline: documents through five stages, each by one operator.

Every stage works on all rows its predecessor kept. The first four return the columns
of their input; the last returns the packed pieces.

* ``language_id`` drops texts in no language (null, or without a letter).
* ``line_dedup`` cuts runs of two or more lines that stand earlier too, and single lines
  of ``LONG_LINE`` or more words that do, and drops documents of which no word is left. ``n_chars``, where there is one, follows the cut text.
* ``ngram_jaccard`` keeps one row of each group of linked texts, whatever their ids, rows
  without an id included: that of the smallest id among those with texts of no other
  group, else of the smallest id, else one without an id. So an id stays in several rows
  only where its texts differ and stand nowhere else. Rows without words stay.
* ``mixing`` repeats or leaves out documents to the target weights of their sources.
* ``packing`` puts what remains into sequences of 4096 tokens.

Empty tables pass through all stages; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftworks.llm import jaccard, language, lines, mixing, packing
from siftworks.llm.common import WORD, staged


#: Words from which a line that stands earlier too is cut without its neighbours.
LONG_LINE = 50


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, language.fit(docs, F.col("doc_id")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(docs, long_line=LONG_LINE)
    emptied = (F.col("_sw_removed") > 0) & (mixing.word_count(F.col("text")) == 0)
    cut = cut.where(~emptied)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col("_sw_removed") > 0, length).otherwise(F.col("n_chars")))
    return cut.select(*[cut[f"`{c}`"] for c in docs.columns])


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = staged(jaccard.text_groups(docs), "groups")
    several = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        (F.min("group") < F.max("group")).alias("several")).where("several")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("several").isNotNull().alias("several"),
                     "doc_id", "text_hash")
    # Written first: the join then reads two plain shuffles, of which hot parts can be split.
    first = found.join(staged(several, "several"), "doc_id", "left").groupBy("group").agg(F.min(place).alias("first"))
    first = staged(first.select(F.col("first.doc_id").alias("_sw_id"), F.col("first.text_hash").alias("_sw_text")), "first")
    hashed = docs.withColumn("_sw_hash", F.xxhash64("text"))
    words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    # Of rows equal in id and text, one; the rank limit is applied before the shuffle too.
    one = Window.partitionBy("doc_id", "_sw_hash").orderBy("_sw_hash")
    kept = (
        hashed.where(words)
        .join(first, F.col("doc_id").eqNullSafe(F.col("_sw_id")) & (F.col("_sw_hash") == F.col("_sw_text")), "left_semi")
        .withColumn("_sw_row", F.row_number().over(one)).where("_sw_row = 1").drop("_sw_row", "_sw_hash")
    )
    return kept.union(docs.where(~words))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mixing", mix_sources),
    ("packing", best_fit_packing),
]

#: Language ID and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
