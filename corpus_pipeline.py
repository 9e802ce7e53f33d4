"""From raw documents to packed training sequences, in five stages over whole tables.

Every stage reads what the one before it wrote. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket.llm import langid, mixing, packing, quality, shingles
from thicket.llm.common import free_name, materialize

LEAST_OUTPUT = 0.1  # of a language's regression: near 1 for its texts, near -1 for those of other known languages, near 0 for what is like none
SURE = 0.9  # of a language that contradicts the declared one
LEAST_QUALITY = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are in none of the languages learned, and those whose declared language is another one
    than the text's.

    The first are texts without a letter (null and empty ones among them) and those that no language's regression takes
    for its own. The second have a ``lang`` that was learned, and a prediction that differs with a score of ``SURE`` or
    more. A null or unknown ``lang`` contradicts nothing. Repeated rows are judged alike; other columns pass; an
    empty table stays empty.
    """
    model, name = langid.learn_documents(docs), free_name(docs, "language")
    found = langid.languages(docs, model, name=name)
    pred, score, output = (F.col(name)[x] for x in ("pred", "score", "output"))
    wrong = F.col("lang").isin(*model.languages) & (F.col("lang") != pred) & (score >= SURE)
    return found.where((pred != "und") & (output > LEAST_OUTPUT) & ~F.coalesce(wrong, F.lit(False))).select(*docs.columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are more likely of label 0 than 1.

    Null texts are scored as empty ones. Labels that are null or without a document teach nothing; without any label all
    documents stay. Repeated rows are judged alike; other columns pass; an empty table stays empty.
    """
    model = quality.learn_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    name = free_name(docs, "quality_score")
    return quality.rate(docs, model, name=name).where(F.col(name) >= LEAST_QUALITY).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (5-word shingles, Jaccard similarity 0.8 or more): that of the
    smallest id, null ids last.

    Null and wordless texts are copies of each other. Of repeated rows one stays. Other columns pass; an empty table
    stays empty.
    """
    return shingles.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their weights; a document comes once for each use, with the words used, and ``n_chars`` of them.

    Documents without words are not in a mix. A null source is a source, the last. Repeated rows are documents of their
    own. Other columns pass; an empty table stays empty.
    """
    mixed = mixing.mix_documents(docs)
    return mixed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else mixed


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096, a row a piece, with the token ids.

    A null text is the end mark alone; a null id stays null; repeated rows are documents of their own; other columns are
    left out; an empty table gives no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("quality", quality_filter),
    ("simhash_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
