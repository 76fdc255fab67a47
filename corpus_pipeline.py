"""The corpus pipeline: from raw documents to packed training sequences.

STAGES lists (name, function).  Each function takes (spark, docs, sf_dir), where docs is what the stage before it
kept, and returns a DataFrame that is written as Parquet and read again as the next one's docs.  All but
the last return the columns of documents.

1. toxicity: documents that the classifier rejects go.  It learns from the labels of the given tables, not
   from those of the held-out fold.
2. line_dedup: lines that three documents or more share go, but for one document.
3. ngram_jaccard: of documents linked by 5-word shingles at a Jaccard similarity of 0.8, the smallest doc_id stays.
4. mixing: documents are drawn by probabilities that rake source, language and topic to target weights; cells that are wanted
   beyond what they hold stay whole.
5. packing: documents become pieces in sequences of 1024 tokens.

Rows with a null doc_id pass stages 1 to 3 (they have no label and link with nothing) and are drawn by their texts in stage 4.
Null text counts as empty: such rows are scored by the classifier's intercept, have one empty line, link with nothing and, as they have no
tokens, are packed as their end alone.  A null language or source is a level of its own in the mixture.  Rows with one doc_id are one document to
the near-duplicate and mixing stages, where they stay or go together.  Texts of any length are worked whole.  Further columns of the table are not
carried on, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm.common import Scratch, table
from tidebook.llm.line_dedup import line_dedup
from tidebook.llm.mixing import mix
from tidebook.llm.ngram_join import ngram_classes
from tidebook.llm.packing import pack_documents
from tidebook.llm.queries import MIX_KEEP, TOXIC_FROM
from tidebook.llm.tokens import public_file
from tidebook.llm.toxicity import fit_on_labels, with_score

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_on_labels(docs, table(spark, sf_dir, "labels"))
    return with_score(docs.select(COLUMNS), model).filter(F.col("toxicity") < TOXIC_FROM).select(COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup(docs, carry=("lang", "source")).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = ngram_classes(docs, n=5, num=80, den=100)
    gone = classes.filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.select(COLUMNS).join(gone, "doc_id", "left_anti").select(COLUMNS)


def draw_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs.select(COLUMNS), keep=MIX_KEEP).filter("selected").select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_file("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", draw_mixture),
    ("packing", pack_sequences),
]

#: A trained classifier, raking and a tokenizer are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
