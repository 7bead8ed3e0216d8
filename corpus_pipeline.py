"""The corpus pipeline: from raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept, and
returns a DataFrame; all but the last return the columns they were given.  Between stages
``run`` writes and rereads Parquet in the folder that all executors share.

Nulls, empty and very long texts, repeated rows, extra columns and empty tables are treated
as the operators say; what that means for a stage is in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import decontaminate, jaccard, pieces, quality, secrets
from rowtide.llm.common import forget, small, stored, table, unused
from rowtide.llm.learn import CUT


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def wrapped(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns in one, so that no operator meets their names."""
    rest = [F.col(quoted(c)) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*rest) if rest else F.lit(None)).alias("rest"))


def unwrapped(df: DataFrame, docs: DataFrame) -> DataFrame:
    """``df`` with the columns of ``docs`` again."""
    return df.select(*[F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c).alias(c) for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier, trained on all labels, rejects.

    Null and empty texts are judged like any text.  Without labels of both kinds nothing goes.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    if model is None:
        return docs
    return unwrapped(quality.scored(wrapped(docs), model).where(F.col("quality_score") >= CUT), docs)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the least id stays.

    Documents are told apart by id and text: a text goes only if it is itself a near copy, also
    where its id occurs with other texts.  Texts without words and rows with a null id stay.
    """
    return jaccard.first_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten words in a row of a benchmark item, or a whole shorter item."""
    key = unused(docs, "key")
    leaks = decontaminate.contaminated_keys(docs, table(spark, sf_dir, "benchmark")).withColumnRenamed("key", key)
    return docs.withColumn(key, decontaminate.document_key()).join(small(leaks), key, "left_anti").drop(key)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; n_chars follows the text.  All documents stay, null texts stay null."""
    ratio = secrets.fit(secrets.samples(docs))
    spans = F.concat("base", "added")
    found = secrets.scan(wrapped(docs), ratio).withColumn("text", secrets.redacted(F.col("text"), spans))
    if "n_chars" in docs.columns:
        own = F.col("rest").getField("n_chars")
        length = F.when(F.size(spans) > 0, F.length("text")).otherwise(own).cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("rest", F.col("rest").withField("n_chars", length))
    return unwrapped(found, docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's sampled pieces, in place of its text and of columns named like them."""
    import public_tokenizers

    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


STAGES = [
    ("quality", keep_quality),
    ("near_copies", keep_one_copy),
    ("benchmark", drop_leaks),
    ("secrets", mask_secrets),
    ("pieces", encode_pieces),
]

#: Trained and sampled stages have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            forget(before)
        before = docs
    return docs
