"""From documents to token ids: toxic text out, near-copies out, personal data masked, sources mixed, encoded.

Each stage takes what its predecessor kept, as a table of the columns of ``documents``. Null texts, empty
tables, repeated rows and extra columns go through as the operators' docstrings say.
"""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakeload.llm import bpe, mixing, neardup, pii, toxicity
from lakeload.llm.common import short_batches, stored, table
from lakeload.llm.queries import DIGESTS, VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted to be toxic by a model learnt from these documents and ``labels``."""
    short_batches(spark)
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: five-word shingles, similarity of 0.8 or more."""
    return neardup.without_copies(docs, neardup.Near(words=5, percent=80))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets."""
    return pii.redact(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their targets."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def _encoded(encoder: bpe.Encoder, text: str | None) -> tuple[np.ndarray, int, str, str]:
    found = encoder.encode(text).astype(np.int32)
    ids = found.tolist()
    written = encoder.written(ids).encode()
    return found, len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest()


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row, with digests of them and of the bytes decoded again."""
    coder = bpe.Bpe(spark, VOCABULARY, public_tokenizers.PATTERN).prepare(docs)
    columns = {"ids": ("array<int>", pa.list_(pa.int32())), **DIGESTS}
    return coder.apply(docs, columns, _encoded, ["doc_id", "source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("personal_data", mask_personal),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: SQL cannot fit the classifier and the tagger, nor draw the mix; tests compare with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each result is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
