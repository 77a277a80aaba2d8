"""The corpus pipeline: five stages over ``documents``, each one operator of ``thylakoid.llm``.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again
as the next one's ``docs``. Stages keep all columns of ``documents``; where a text changes, ``n_chars``
follows it. The last stage returns the encodings.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thylakoid.llm.common import materialize, scratch_folder
from thylakoid.llm.decontamination import contaminated, decontaminate
from thylakoid.llm.language_id import fit, identify
from thylakoid.llm.line_dedup import drop_repeated_lines
from thylakoid.llm.pieces import encode_decode
from thylakoid.llm.simhash import drop_alike


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: those without a letter (so null and empty texts), and
    those unlike the sample's texts of their length. Null ids, repeated rows and long texts are judged
    like others; rows without a language aren't learned from."""
    return identify(docs, fit(docs), carry=True).filter(~F.col("rejected")).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; a document keeps its row even if no line is left.

    Rows of null ids keep all lines; rows that repeat an id count as one document. Texts that lose no
    line, null ones too, and their ``n_chars`` stay as they are."""
    out = drop_repeated_lines(docs, carry=True)
    changed = F.col("n_dropped") > 0
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*[F.when(changed, new[c]).otherwise(F.col("row")[c]).alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8), the row with the smallest id stays.

    It is decided by row: of rows that repeat an id each goes or stays by its own text, of equal rows one
    stays. Null ids come last. Null, empty and blank texts are no copies and stay."""
    return drop_alike(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words, one at least, lies in benchmark windows go. Null and
    empty texts have no words and stay; null ids and repeated rows are judged like others."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, bench, offsets=False, carry=True).filter(~contaminated()).select("row.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encodings of the texts that are left (``ids``: little-endian unsigned 32-bit integers), and
    digests of them and of what they decode to. A null text counts as empty; every row has its own."""
    out = encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece", sentencepiece),
]

#: The stages hold a trained model, components and an encoder, which SQL can't express; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, over the whole of ``documents``."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch_folder(spark)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), folder)
    return STAGES[-1][1](spark, docs, sf_dir)
