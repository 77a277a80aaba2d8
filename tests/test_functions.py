"""Sequence expressions, row by row."""

import pytest
from pyspark.sql import functions as F

from thylakoid.functions import sequence as fx
from thylakoid.operators.kmers import kmer_codes


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first().x


@pytest.mark.parametrize("seq, want", [("ACGTacgtnN", "NnacgtACGT"), ("", ""), ("AXR-", "-RXT")])
def test_revcomp(spark, seq, want):
    assert one(spark, fx.revcomp(F.col("s")), s=seq) == want
    assert one(spark, fx.revcomp(fx.revcomp(F.col("s"))), s=seq) == seq


def test_rotate_and_flip(spark):
    for cut in range(6):
        assert one(spark, fx.rotate(F.col("s"), F.lit(cut)), s="ACGTT") == "ACGTT"[cut:] + "ACGTT"[:cut]
    assert one(spark, fx.flip_segment(F.col("s"), F.lit(2), F.lit(3)), s="AACC") == "AGTC"
    assert one(spark, fx.flip_segment(fx.flip_segment(F.col("s"), F.lit(1), F.lit(4)), F.lit(1), F.lit(4)), s="AACG") == "AACG"


def test_kmer_codes():
    at, code = kmer_codes("acgNtaca", 3)
    assert at.tolist() == [0, 4, 5] and code.tolist() == [0b000110, 0b110001, 0b000100]
    assert [len(x) for x in kmer_codes("ac", 3)] == [0, 0] == [len(x) for x in kmer_codes(None, 3)]
    long = "ACGTTGCA" * 20_000
    at, code = kmer_codes(long, 31)
    assert len(at) == len(long) - 30 and len(set(code.tolist())) == 8


@pytest.mark.parametrize("a, b, want", [("ACGT", "ACGA", 1), ("ANNN", "TCGA", 1), ("ACG", "AC", 0), ("", "ACG", 0), ("GGG", "AAANNN", 3)])
def test_hamming(spark, a, b, want):
    assert one(spark, fx.hamming(F.col("a"), F.col("b")), a=a, b=b) == want


@pytest.mark.parametrize("v, r, want", [("110", "100", True), ("110.1", "100", False), ("0", "0", True), ("1", "0", False), ("x", "1", False), ("", "1", False), ("nan", "1", False), ("1", "nan", False), (None, "1", False), ("-95", "-100", True)])
def test_within(spark, v, r, want):
    row = spark.createDataFrame([(v, r)], "v string, r string").select(fx.within(F.col("v"), F.col("r")).alias("x")).first()
    assert row.x is want


def test_majority_base_breaks_ties_in_order(spark):
    cases = {(2, 2, 1, 0): "A", (0, 3, 3, 3): "C", (0, 0, 1, 1): "G", (0, 0, 0, 2): "T", (0, 0, 0, 0): None}
    for counts, want in cases.items():
        assert one(spark, fx.majority_base(*map(F.lit, counts))) == want


@pytest.mark.parametrize("name, want", [("Option_12_s1_1.fastq.gz_x_pileup.tsv", "s1_1_x"), ("s_Novowrap.anything.fasta", "s"), ("a.FASTA", "a"), ("b.fastq", "b_"), ("c", "c")])
def test_names(spark, name, want):
    assert one(spark, fx.normalized_name(F.col("n")), n=name) == want


def test_records(spark):
    assert one(spark, fx.one_line_record(F.lit("h"), F.lit("AC\n GT"))) == ">h\nACGT"
    assert one(spark, fx.record_header(F.lit("a"), F.lit("b"), F.lit(7))) == ">a, b, 7"
    assert one(spark, fx.ungap(F.lit("A-C.G"))) == "ACG"
    assert one(spark, fx.sample_base(F.lit("/x/y_1.fastq.gz"))) == "y" and one(spark, fx.sample_base(F.lit("/x/y.fastq.gz"))) is None
