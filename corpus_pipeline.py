"""From raw documents to token ids: the stages of a training corpus.

Each stage takes the rows that its predecessor kept. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealoom.llm import bpe, decontaminate, langid, oddsketch, suffixes
from arealoom.session import Steps

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bytes of texts that go to a Python worker at once, and of the memo of pieces that each worker keeps.
BATCH_BYTES, TOKEN_MEMO_BYTES = 8 << 20, 24 << 20


def bound_batches(docs: DataFrame) -> DataFrame:
    """The table itself; its session sends whole texts to Python in batches of bounded bytes (by number
    of rows alone a batch of long texts takes hundreds of megabytes on either side)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = docs.sparkSession.conf.get(name, None) or ""
    if not before.isdigit() or int(before) > BATCH_BYTES:
        docs.sparkSession.conf.set(name, str(BATCH_BYTES))
    return docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not told with enough confidence go. The model learns from the
    labelled documents outside the held-out fifth. Texts that are null or have no letter have no language
    and go; rows without an id are judged by their text."""
    docs = bound_batches(docs).select(*COLUMNS)
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    return langid.predict(docs, model).filter("accepted").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the smallest id. Words in
    shingles of five. Rows that share an id are judged by their own texts; of rows with one id and one
    text, one stays; rows without an id all stay."""
    return oddsketch.first_of_each(bound_batches(docs).select(*COLUMNS), k=5, percent=80)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that also start earlier go; a character that a cut would split goes with
    them. Every document stays, with what is left of its text (empty for a null text)."""
    cut = suffixes.remove(bound_batches(docs).select(*COLUMNS), carry=True, as_text=True)
    return cut.select(
        "row.doc_id",
        F.col("kept").alias("text"),
        "row.lang",
        "row.source",
        F.char_length("kept").cast("long").alias("n_chars"),
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of which a twentieth of the words or more stands in 13-word windows of the
    benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(bound_batches(docs).select(*COLUMNS), items)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids by the public byte-level ranks (packed, little-endian, 32 bits), and whether they decode to
    the text again. A null text has no ids and is intact; rows without an id pass like all others."""
    vocab = bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = bound_batches(docs).select("doc_id", "text", "lang", "source")
    coded = bpe.checked(rows, vocab, public_tokenizers.PATTERN, memo_bytes=TOKEN_MEMO_BYTES)
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return coded.select("doc_id", "lang", "source", n_tokens, "ids", "intact")


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", remove_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_bpe", encode_tokens),
]

#: Sampling by a hash of the ids, gradient descent and token ids are beyond SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder for the next. What a stage wrote on
    its way, and its input, go when its table is there; the input of the last stage stays until
    ``session.drop_scratch``, as its result reads it."""
    docs, steps = spark.read.parquet(f"{sf_dir}/documents.parquet"), Steps(spark)
    for name, stage in STAGES[:-1]:
        docs = steps.write(lambda: stage(spark, docs, sf_dir), name)  # noqa: B023
    return STAGES[-1][1](spark, docs, sf_dir)
