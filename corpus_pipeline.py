"""From documents to packed training sequences, in five stages.

Each stage takes what the one before it kept, as written and read again, and returns the columns
of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import jaccard, mixing, packing, quality, rlz
from tessella.llm.common import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose line-level score is at least 0.3; the classifier learns from ``labels``."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_quality(docs.select(*COLUMNS), model).where("quality_good").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles (similarity 0.8 or more) the document of smallest id.

    Documents without words are in no group and stay. Null ids come after all others: a group
    that has no id at all keeps the row of smallest text. Rows that repeat the id that stays are
    copies or rivals for it: one of them stays, that of smallest text.
    """
    sized, classes = jaccard.linked_groups(docs, words=jaccard.WORDS, least=jaccard.LEAST, of=jaccard.OF)
    groups = jaccard.labelled(sized, classes)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    first = docs.select(*COLUMNS).where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi")
    again = staged(sized.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "repeated")
    least = F.min(F.struct("text", "lang", "source", "n_chars")).alias("r")
    null = jaccard.with_set_id(docs.select(*COLUMNS).where("doc_id IS NULL"), words=jaccard.WORDS)
    alone = classes.where("component_id IS NULL").select("hi", "lo", "root")
    only = null.join(alone, ["hi", "lo"]).groupBy("root").agg(F.min("doc_id").alias("doc_id"), least)
    null = null.where("hi IS NULL").select(*COLUMNS).unionByName(only.select("doc_id", "r.*"))
    if again.isEmpty():
        return first.unionByName(null)
    single = first.join(again, "doc_id", "left_anti")
    rivals = first.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(least)
    return single.unionByName(rivals.select("doc_id", "r.*")).unionByName(null)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that a document of smaller id has in a 13-word window.

    A text that loses nothing stays as it is; of the others the words left are joined by blanks,
    and a text that has lost all its words goes.
    """
    found = rlz.substring_dedup(docs.select(*COLUMNS))
    text = F.when(F.col("rlz_removed") > 0, F.col("rlz_kept")).otherwise(F.col("text"))
    kept = found.where("rlz_removed = 0 OR rlz_removed < rlz_words")
    return kept.withColumn("text", text).withColumn("n_chars", F.when(F.col("rlz_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, none to two times."""
    return mixing.repeat_copies(mixing.mix_sources(docs.select(*COLUMNS)), COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", reject_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("mixing", mix_to_weights),
    ("packing", pack_sequences),
]

#: The classifier, the similarity of components and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
