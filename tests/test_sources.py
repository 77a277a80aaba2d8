"""Readers and writers on files made here."""

import gzip

import pytest
from pyspark.sql import functions as F

from thylakoid.operators.pileup import BUCKETS
from thylakoid.sources import files


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fasta").write_text("junk\n>one > x\nAC\n gt \n\n>two\n>three\nNN\n")
    (tmp_path / "b.fasta").write_text(">only\r\nAC\r\nGT")
    rows = files.read_fasta(spark, str(tmp_path / "*.fasta"))
    got = sorted((r.file.rsplit("/", 1)[1], r.rec_ord, r.header, r.seq, r.len) for r in rows.collect())
    assert got == [("a.fasta", 0, ">one > x", "ACgt", 4), ("a.fasta", 1, ">two", "", 0), ("a.fasta", 2, ">three", "NN", 2), ("b.fasta", 0, ">only", "ACGT", 4)]
    assert files.first_records(rows).count() == 2
    files.write_fasta(rows.filter("rec_ord = 0"), str(tmp_path / "out"))
    again = files.read_fasta(spark, str(tmp_path / "out"))
    assert {(r.header, r.seq) for r in again.collect()} == {(">one > x", "ACgt"), (">only", "ACGT")}


def test_fastq(spark, tmp_path):
    for name, seqs in (("s_1", ["ACGT", "GG"]), ("t_1", ["TTT"])):
        with gzip.open(tmp_path / f"{name}.fastq.gz", "wt") as f:
            f.write("".join(f"@{name}.{i}\n{s}\n+\n{'I' * len(s)}\n" for i, s in enumerate(seqs)))
    got = sorted((r["sample"], r.mate, r.read_idx, r.name, r.seq, r.qual) for r in files.read_fastq(spark, str(tmp_path), 1).collect())
    assert got == [("s", 1, 0, "s_1.0", "ACGT", "IIII"), ("s", 1, 1, "s_1.1", "GG", "II"), ("t", 1, 0, "t_1.0", "TTT", "III")]


def test_plain_files_are_numbered_over_splits(spark, tmp_path):
    (tmp_path / "big_1.fastq").write_text("".join(f"@r{i}\n{'ACGT' * (1 + i % 5)}\n+\n{'@' * (4 + 4 * (i % 5))}\n" for i in range(2000)))
    (tmp_path / "big.fasta").write_text("; before\n" + "".join(f">s{i} > x\nAC\n{'GT' * (i % 7)}\n" for i in range(2000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        reads = files.read_fastq(spark, str(tmp_path / "big_1.fastq"), 1).collect()
        records = files.read_fasta(spark, str(tmp_path / "big.fasta")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.read_idx, r.name, len(r.seq), len(r.qual)) for r in reads) == [(i, f"r{i}", 4 + 4 * (i % 5), 4 + 4 * (i % 5)) for i in range(2000)]
    assert sorted((r.rec_ord, r.header, r.seq) for r in records) == [(i, f">s{i} > x", "AC" + "GT" * (i % 7)) for i in range(2000)]


def test_first_records(spark, tmp_path):
    (tmp_path / "a.fasta").write_text("x\n>one\nAC\n>two\nGG\n")
    assert [(r.header, r.seq) for r in files.read_first_record(spark, str(tmp_path)).collect()] == [(">one", "AC")]
    (tmp_path / "b.fasta").write_text("ACGT\n")
    with pytest.raises(Exception, match="no sequence header in .*b.fasta"):
        files.read_first_record(spark, str(tmp_path)).collect()


def test_first_records_of_rows_in_any_order(spark, tmp_path):
    """Files hold their source's rows by id whatever the order in which rows come, also of sources whose names no path can have."""
    from thylakoid.plans import catalog

    names = ["", "a+b", "x/y", "p%20q", "é ü", None]
    rows = [(i, "ACGT" * (i % 5 + 1), names[i % 6]) for i in range(3000)]
    spark.createDataFrame(rows[::-1], "doc_id long, text string, source string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.source, r.header, r.seq) for r in catalog.first_records(spark, str(tmp_path)).collect())
    assert got == sorted((names[i], f">d{i}", "ACGT" * (i + 1)) for i in range(5))


def test_listings(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "s1_1.fastq.gz").write_text("x")
    (tmp_path / "x" / "s1.fasta").write_text("x")
    rows = files.list_files(spark, str(tmp_path))
    assert {r.name for r in rows.collect()} == {"s1_1.fastq.gz", "s1.fasta"}
    assert [r.name for r in files.files_named(rows, "s1").collect()] == ["s1.fasta"]
    (tmp_path / "pairs.txt").write_text("a , b,c\n\n  \nd,e\n")
    assert {tuple(r) for r in files.read_pair_list(spark, str(tmp_path / "pairs.txt")).collect()} == {("a", "b,c"), ("d", "e")}


def test_metrics(spark, tmp_path):
    (tmp_path / "p" / "q").mkdir(parents=True)
    (tmp_path / "p" / "m.csv").write_text("Input,Length\nx,1\ny,\n")
    (tmp_path / "p" / "q" / "n.CSV").write_text("Input,Length\nz,a b\n")
    rows = files.read_metrics(spark, str(tmp_path), ["Input", "Length"]).collect()
    assert {(r.folder.rsplit("/", 1)[1], r.Input, r.Length) for r in rows} == {("p", "x", "1"), ("p", "y", None), ("q", "z", "a b")}


def test_metrics_files_have_headers_of_their_own(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Input,Length,Note\nx,1,"n, m"\n\ny,2,\n')
    (tmp_path / "b.csv").write_text("LSC,Length,Input\n9,7,z\n")
    rows = files.read_metrics(spark, str(tmp_path), ["Input", "Length", "LSC", "Note"]).collect()
    assert sorted((r.Input, r.Length, r.LSC, r.Note, r.row_ord) for r in rows) == [("x", "1", None, "n, m", 1), ("y", "2", None, None, 3), ("z", "7", "9", None, 1)]
    assert files.read_metrics(spark, str(tmp_path)).columns == [*files.METRICS, "folder", "row_ord"]


def test_pileups(spark, tmp_path):
    (tmp_path / "raw").write_text("c\t1\tA\t3\t.,T\tIII\n\nc\t2\tN\t0\t*\t*\n")
    counts = files.read_mpileup(spark, str(tmp_path / "raw"))
    assert {(r.pos, r.ref, r.ref_fwd, r.t, r.other) for r in counts.collect()} == {(1, "A", 1, 1, 0), (2, "N", 0, 0, 0)}
    files.write_pileup_table(counts, str(tmp_path / "table"))
    table = files.read_pileup_table(spark, str(tmp_path / "table"))
    assert {(r.chrom, r.pos, r.ref_rev, r.t) for r in table.collect()} == {("c", 1, 1, 1), ("c", 2, 0, 0)}
    (tmp_path / "odd").write_text("# x\nCHROM\tPOS\nc\t1\t0\t0\t1\t2\t3\t4\nc\tx\t0\t0\t1\t2\t3\t4\nc\t2\t0\n")
    assert [tuple(r) for r in files.read_pileup_table(spark, str(tmp_path / "odd")).collect()] == [("c", 1, 0, 0, 1, 2, 3, 4)]
    assert len(files.PILEUP_HEADER) == len(BUCKETS) + 2


RECORD = """LOCUS       X  20 bp
FEATURES             Location/Qualifiers
     source          1..20
                     /organism="Some
                     plant"
     gene            complement(join(3..5,
                     8..9))
                     /gene="g"
                     /note="a=b"
     CDS             join(complement(1..2),18..20)
ORIGIN
        1 acgtacgtac gtacgtacgt
//
"""


def test_annotations(spark, tmp_path):
    (tmp_path / "r.gb").write_text(RECORD)
    (tmp_path / "two.gb").write_text(RECORD + RECORD.replace("LOCUS       X", "LOCUS       Y"))
    both, _ = files.read_genbank(spark, str(tmp_path / "two.gb"))
    assert {(r.record, r.feature_id) for r in both.collect()} == {(x, i) for x in "XY" for i in range(3)}
    features, seqs = files.read_genbank(spark, str(tmp_path / "r.gb"))
    got = {r.feature_id: (r.key, r.strand, [tuple(p) for p in r.parts], r.quals) for r in features.collect()}
    assert got[0] == ("source", 1, [(1, 20, 1)], {"organism": ["Some plant"]})
    assert got[1] == ("gene", -1, [(3, 5, -1), (8, 9, -1)], {"gene": ["g"], "note": ["a=b"]})
    assert got[2] == ("CDS", 0, [(1, 2, -1), (18, 20, 1)], {})
    assert [(r.seq, r.len) for r in seqs.collect()] == [("ACGTACGTACGTACGTACGT", 20)]
    # sequences are cut out by Spark alone, and only tables of features go to Python
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "MapIn" not in plan(seqs) and "origin" not in plan(features)


def test_versions(spark):
    names = spark.createDataFrame([("Set_2.fasta",), ("set_11.FASTA",), ("Set_x.fasta",), ("Other_99.fasta",)], "name string")
    assert files.next_version(names, "Set").first().version == 12
    assert files.next_version(names.limit(0), "Set").first().version == 1
    assert files.named_like(spark.createDataFrame([("a_pileup.tsv",)], "name string")).first()["sample"] == "a"


def test_arriving_pairs(spark, tmp_path):
    from thylakoid.streaming.arrivals import arriving_pairs

    for name in ("s_1.fastq.gz", "s_2.fastq.gz", "t_1.fastq.gz"):
        (tmp_path / name).write_text("x")
    stream = arriving_pairs(spark, str(tmp_path)).writeStream.format("memory").queryName("arrived").outputMode("append").start()
    try:
        stream.processAllAvailable()
        assert [r["sample"] for r in spark.table("arrived").select(F.col("sample")).collect()] == ["s"]
    finally:
        stream.stop()
