"""A corpus from raw documents to tokens, stage by stage.

Every stage but the last returns the columns of ``documents``, and others that the table may
have, whatever their names. ``doc_id`` names a document throughout; where a stage changes a
text, ``n_chars`` follows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscore.llm.bpe import encode_decode
from subscore.llm.decontaminate import benchmark_spans
from subscore.llm.line_dedup import remove_repeated_lines
from subscore.llm.ngram_join import drop_similar_texts
from subscore.llm.quality import fit_quality, score_quality
from subscore.llm.queries import RUN_WORDS, table, tokenizer_path
from subscore.session import remove_scratch, scratch_path, scratch_scope


#: What the stages themselves look at.
OWN = ("doc_id", "text", "n_chars")


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with its other columns named by their place, so that no operator replaces them."""
    return docs.toDF(*(name if name in OWN else f"~{at}" for at, name in enumerate(docs.columns)))


def named(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` out of what an operator made of ``numbered(docs)``."""
    return found.select(*(f"`{name}`" for name in numbered(docs).columns)).toDF(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects: a score below 0.7.

    Null and empty texts get the score of the bias. Equal texts get equal scores, so repeated
    rows stay or go together. Texts of any length are scored whole. Without labels all scores
    are 0.5 and everything goes; an empty table stays empty.
    """
    weights = fit_quality(docs, table(spark, sf_dir, "labels"))
    return named(score_quality(numbered(docs), weights).where("score >= 0.7"), docs)


def without_repeated_lines(docs: DataFrame, min_lines: int, min_words: int = 0) -> DataFrame:
    """Without later copies of runs of lines that count; what has nothing left goes."""
    left = remove_repeated_lines(numbered(docs), min_lines, min_words=min_words)
    changed = F.col("n_removed") > 0
    left = left.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")))
    return named(left.where(~(changed & (F.col("n_removed") == F.col("n_lines")))), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later copies of runs of five or more words, be they one line.

    The copy in the document with the smallest id stays, a missing id coming first. Null texts
    and texts without words stay as they are. Rows with the same id and text are one document
    and stay or go together. Long texts and lines are compared whole; an empty table stays empty.
    """
    return without_repeated_lines(docs, min_lines=1, min_words=RUN_WORDS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of similar texts.

    Equal texts are similar, null and empty ones included, so one of all of these stays. Of rows
    that are wholly equal in id and text one stays; of rows with the smallest id and different
    texts, that with the smallest digest. A missing id comes last. Long texts are compared whole;
    an empty table stays empty.
    """
    return named(drop_similar_texts(numbered(docs)), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of ten words, or a whole item, of the benchmark.

    Null and empty texts hold nothing and stay; repeated rows stay or go together. Long texts
    are searched whole. Without items everything stays; an empty table stays empty.
    """
    found = benchmark_spans(numbered(docs), table(spark, sf_dir, "benchmark"))
    return named(found.where(F.size("spans") == 0), docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, token ids and the text that they decode to, of every document.

    A null text is the empty one, with no tokens. Repeated rows come out as often as they came
    in, and rows without id keep none. Long texts are encoded whole; an empty table stays empty.
    """
    coded = encode_decode(docs, tokenizer_path(), keep=["doc_id"])
    n_tokens = F.size("ids").cast("long").alias("n_tokens")
    return coded.select("doc_id", n_tokens, "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("bpe", bpe),
]

#: SQL can say neither the classifier nor the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again.

    What a stage wrote on its way goes once its result is written, and so does that of the
    stage before, so one result and the work of one stage lie in the folder at a time.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    *others, (_, last) = STAGES
    for name, stage in others:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove_scratch(spark, before)
        before = path
    return last(spark, docs, sf_dir)
