"""Corpus pipeline: documents to packed training sequences.

Each stage works on all rows its predecessor kept, is written as Parquet and reread. All but the last return the columns of
documents. A toxic document goes with all its rows of the same id and text; clean ones stay.
"""
import uuid

import public_tokenizers

from opsloom.llm import exact_dedup, near_copies, packing, repeats, toxicity
from opsloom.llm.common import kept_rows_by, table
from opsloom.session import checkpoint_dir


def without_toxic(spark, docs, sf_dir):
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return kept_rows_by(docs, scored, "predicted = 0")


def without_exact_copies(spark, docs, sf_dir):
    return exact_dedup.exact_dedup(docs)


def without_near_copies(spark, docs, sf_dir):
    return near_copies.without_near_copies(docs)


def without_repeated_passages(spark, docs, sf_dir):
    return repeats.without_repeats(docs)


def packed_sequences(spark, docs, sf_dir):
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_exact_copies),
    ("near-dedup", without_near_copies),
    ("suffix-array dedup", without_repeated_passages),
    ("best-fit packing", packed_sequences),
]
# The classifier, the fingerprints' components and the packing are no SQL; tests compare the stages with plain code.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Rows of the last stage over the documents of sf_dir. Stages are written to the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    place = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{number}")
        docs = spark.read.parquet(f"{place}/{number}")
    return docs
