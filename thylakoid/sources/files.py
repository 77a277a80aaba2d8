"""Readers and writers of the file formats: sequences, reads, pileups, metrics, listings, annotations."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thylakoid.functions.sequence import normalized_name, one_line_record
from thylakoid.operators.pileup import BUCKETS, parse_pileup

#: The header of a pileup table's file.
PILEUP_HEADER = ["CHROM", "POS", ".", ",", "A", "C", "G", "T", "N", "+", "-", "^", "$", "other"]


def _numbered(rows: DataFrame, *firsts) -> DataFrame:
    """Text rows (``file, block, id, value``) with ``nth``, their number (from 0) in the file.

    Files are read in splits (``block`` is where one begins); rows of one split follow each other, so a
    split's first row and the counts of the splits before it number them. Only counts, one row a split,
    are gathered by file; rows stay where they are read. ``firsts`` are further aggregations of a file's first split.
    """
    splits = rows.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"), *firsts)
    order = Window.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    more = [F.first(c).over(order).alias(c) for c in splits.columns[4:]]
    offsets = splits.select("file", "block", (before - F.col("first")).alias("shift"), *more)
    return rows.join(offsets, ["file", "block"]).withColumn("nth", F.col("id") + F.col("shift")).drop("shift")


def _text_rows(spark: SparkSession, path: str, sep: str | None = None, **options: str) -> DataFrame:
    reader = spark.read.options(**options)
    rows = (reader.option("lineSep", sep) if sep else reader).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Records of sequence files: ``file, rec_ord, header`` (with ``>``), ``seq``, ``len``.

    The text reader splits at ``>`` after a line end, so large files are read and numbered in parallel and a ``>``
    inside a header does no harm. Text before the first header is dropped; lines are stripped and joined.
    """
    headless = F.min_by(~F.startswith("value", F.lit(">")), "id").alias("headless")
    raw = _numbered(_text_rows(spark, path, "\n>"), headless)
    first = F.col("nth") == 0
    marked = raw.filter(~first | ~F.col("headless"))
    body = F.when(first, F.substr("value", F.lit(2))).otherwise(F.col("value"))
    lines = F.split(body, "\n")
    seq = F.array_join(F.transform(F.slice(lines, 2, 1 << 30), lambda x: F.trim(F.translate(x, "\r\t", ""))), "")
    order = (F.col("nth") - F.col("headless").cast("long")).cast("int")
    return marked.select("file", order.alias("rec_ord"), F.concat(F.lit(">"), F.rtrim(F.translate(lines[0], "\r", ""))).alias("header"), seq.alias("seq")).withColumn("len", F.length("seq"))


def read_first_record(spark: SparkSession, path: str) -> DataFrame:
    """The first record of each file; reading fails on a file that holds text but no header."""
    texts = _text_rows(spark, path).filter(F.trim("value") != "").select("file").distinct()
    found = texts.join(first_records(read_fasta(spark, path)), "file", "left")
    missing = F.raise_error(F.concat(F.lit("no sequence header in "), F.col("file")))
    return found.withColumn("header", F.when(F.col("header").isNull(), missing.cast("string")).otherwise(F.col("header")))


def first_records(records: DataFrame) -> DataFrame:
    """The first record of each file."""
    return records.filter("rec_ord = 0")


def write_fasta(records: DataFrame, path: str) -> None:
    """Records with each sequence on one line."""
    records.select(one_line_record(F.col("header"), F.col("seq")).alias("value")).write.text(path)


def read_fastq(spark: SparkSession, path: str, mate: int) -> DataFrame:
    """Reads: ``sample, mate, read_idx, name, seq, qual``. Compressed files are one task each; repartition after."""
    lines = _numbered(_text_rows(spark, path))
    lines = lines.select("file", F.expr("nth div 4").alias("read_idx"), (F.col("nth") % 4).alias("field"), "value")
    part = {i: F.max(F.when(F.col("field") == i, F.col("value"))) for i in (0, 1, 3)}
    reads = lines.groupBy("file", "read_idx").agg(part[0].alias("name"), part[1].alias("seq"), part[3].alias("qual")).filter(F.startswith("name", F.lit("@")))
    sample = F.regexp_extract("file", r"([^/]*?)(_[12])?\.(?:fastq|fq)(?:\.gz)?$", 1)
    return reads.select(sample.alias("sample"), F.lit(mate).alias("mate"), "read_idx", F.substr("name", F.lit(2)).alias("name"), "seq", "qual")


def write_fastq(reads: DataFrame, path: str) -> None:
    """Reads (``name, seq, qual``) as compressed files of four lines a read."""
    lines = F.concat(F.lit("@"), "name", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")
    reads.select(lines.alias("value")).write.option("compression", "gzip").text(path)


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Paths, names, folders and times of files that hold something, at any depth; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"), "modificationTime", "length")


def files_named(files: DataFrame, part: str) -> DataFrame:
    """Sequence files whose name holds a text."""
    return files.filter(F.contains("name", F.lit(part)) & F.endswith("name", F.lit(".fasta")))


def read_pair_list(spark: SparkSession, path: str) -> DataFrame:
    """``r1_path, r2_path`` from lines ``a,b``, cut at the first comma; blank lines are skipped."""
    parts = F.split(F.trim("value"), ",", 2)
    return spark.read.text(path).filter(F.trim("value") != "").select(F.trim(parts[0]).alias("r1_path"), F.trim(F.get(parts, F.lit(1))).alias("r2_path"))


def write_pair_list(pairs: DataFrame, path: str) -> None:
    pairs.select(F.concat_ws(",", "r1_path", "r2_path").alias("value")).write.text(path)


#: The columns of a metrics file that the selection reads.
METRICS = ["Input", "Length", "Ref_length", "LSC", "IRa", "SSC", "IRb", "r_LSC", "r_IRa", "r_SSC", "r_IRb"]


def read_metrics(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    """The named columns of all metrics files under a folder (``.csv`` in any case), as text, with ``folder``
    and ``row_ord``.

    Every file is read by its own header line, whatever the order of its columns; a column that it lacks is
    null, as are blank fields. Blank lines are skipped. A quoted field may hold commas but no line end.
    """
    columns = METRICS if columns is None else columns
    rows = _numbered(_text_rows(spark, folder, recursiveFileLookup="true", pathGlobFilter="*.[cC][sS][vV]")).filter(F.trim("value") != "")
    width = (rows.agg(F.max(F.length("value") - F.length(F.replace("value", F.lit(","))))).first()[0] or 0) + 1
    fields = F.array(*[F.col(f"f.c{i}") for i in range(width)])
    cut = rows.withColumn("f", F.from_csv("value", ", ".join(f"c{i} string" for i in range(width)))).select("file", "nth", fields.alias("f"))
    heads = cut.filter("nth = 0").select("file", F.col("f").alias("head"))
    body = cut.filter("nth > 0").join(heads, "file")
    named = [F.when(F.array_position("head", c) > 0, F.try_element_at("f", F.array_position("head", c).cast("int"))).alias(c) for c in columns]
    return body.select(*named, F.regexp_extract("file", r"^(.*)/[^/]*$", 1).alias("folder"), F.col("nth").alias("row_ord"))


def read_mpileup(spark: SparkSession, path: str) -> DataFrame:
    """Raw pileup lines, counted: ``chrom, pos, ref`` and the twelve buckets."""
    f = F.split("value", "\t", 6)
    rows = spark.read.text(path).filter(F.trim("value") != "").select(f[0].alias("chrom"), f[1].try_cast("int").alias("pos"), f[2].alias("ref"), parse_pileup(F.get(f, F.lit(4))).alias("n"))
    return rows.select("chrom", "pos", "ref", "n.*")


def read_pileup_table(spark: SparkSession, path: str) -> DataFrame:
    """A pileup table: comments, headers and rows that lack a number in the first eight fields are skipped."""
    f = F.split("value", "\t")
    names = list(BUCKETS)[:6]
    lines = spark.read.text(path).filter((F.trim("value") != "") & ~F.startswith("value", F.lit("#")) & ~F.startswith("value", F.lit("CHROM")))
    rows = lines.select(F.get(f, F.lit(0)).alias("chrom"), F.get(f, F.lit(1)).try_cast("int").alias("pos"), *[F.get(f, F.lit(i + 2)).try_cast("int").cast("long").alias(n) for i, n in enumerate(names)])
    return rows.dropna()


def write_pileup_table(counts: DataFrame, path: str) -> None:
    counts.select("chrom", "pos", *BUCKETS).toDF(*PILEUP_HEADER).write.option("sep", "\t").option("header", True).csv(path)


def next_version(names: DataFrame, stem: str, name: str = "name") -> DataFrame:
    """The number after the highest ``<stem>_<n>.fasta``, 1 if there is none."""
    n = F.regexp_extract(F.col(name), rf"(?i)^{stem}_(\d+)\.fasta$", 1).try_cast("int")
    return names.agg((F.coalesce(F.max(n), F.lit(0)) + 1).alias("version"))


def named_like(files: DataFrame, name: str = "name") -> DataFrame:
    return files.withColumn("sample", normalized_name(F.col(name)))


_FEATURE = re.compile(r"^ {5}(\S+)\s+(\S.*)$")
_PART = re.compile(r"[<>]?(\d+)(?:\.\.[<>]?(\d+))?")


def _location(text: str) -> tuple[int, list[tuple[int, int, int]]]:
    """Strand and parts of a feature's location, which may nest complement() and join()."""
    parts, depth, flips = [], 0, []
    i = 0
    while i < len(text):
        if text.startswith("complement(", i):
            depth += 1
            flips.append(depth)
            i += len("complement(")
        elif text[i] == "(":
            depth += 1
            i += 1
        elif text[i] == ")":
            if flips and flips[-1] == depth:
                flips.pop()
            depth -= 1
            i += 1
        elif m := _PART.match(text, i):
            parts.append((int(m[1]), int(m[2] or m[1]), -1 if len(flips) % 2 else 1))
            i = m.end()
        else:
            i += 1
    strands = {s for *_, s in parts}
    return (strands.pop() if len(strands) == 1 else 0), parts


def _features(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Annotated records' tables, one a row -> their features."""
    for batch in tables:
        rows = []
        for path, record, table in zip(*(c.to_pylist() for c in batch.columns)):
            n, key, where, quals = 0, None, "", []
            for line in table.partition("\nFEATURES")[2].split("\n")[1:] + ["     end             0"]:
                if head := _FEATURE.match(line):
                    if key:
                        strand, parts = _location(where)
                        held: dict[str, list[str]] = {}
                        for q in quals:
                            name, _, value = q.partition("=")
                            held.setdefault(name, []).append(value.strip('"'))
                        rows.append((path, record, n, key, strand, [{"s": a, "e": b, "strand": d} for a, b, d in parts], list(held.items())))
                        n += 1
                    key, where, quals = head[1], head[2].strip(), []
                elif line[:21].strip() == "" and key:
                    text = line.strip()
                    if text.startswith("/"):
                        quals.append(text[1:])
                    elif quals:
                        quals[-1] += ("" if quals[-1].startswith("translation") else " ") + text
                    else:
                        where += text
        columns = zip(*rows) if rows else [[]] * len(_FEATURES)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _FEATURES)], schema=_FEATURES)


_PARTS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("strand", pa.int32())]))
_FEATURES = pa.schema([("file", pa.string()), ("record", pa.string()), ("feature_id", pa.int32()), ("key", pa.string()), ("strand", pa.int32()), ("parts", _PARTS), ("quals", pa.map_(pa.string(), pa.list_(pa.string())))])


def read_genbank(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Features (``file, record, feature_id, key, strand`` (0: mixed), ``parts, quals``) and sequences
    (``file, record, seq, len``) of annotated records, of which a file may hold many: files are split at
    records' ends. Sequences are cut out by Spark's own functions; only the tables of features are walked line by line."""
    whole = _text_rows(spark, path, "\n//").filter(F.contains("value", F.lit("\nFEATURES")))
    table = F.substring_index("value", "\nORIGIN", 1)
    cut = whole.select("file", F.regexp_extract("value", r"LOCUS[\s\x1c-\x1f]*([^\s\x1c-\x1f]+)", 1).alias("record"), table.alias("table"), F.substr("value", F.length(table) + len("\nORIGIN") + 1).alias("origin"))
    features = cut.select("file", "record", "table").mapInArrow(_features, "file string, record string, feature_id int, key string, strand int, parts array<struct<s: int, e: int, strand: int>>, quals map<string, array<string>>")
    seq = F.upper(F.regexp_replace("origin", "[^a-zA-Z]+", ""))
    return features, cut.select("file", "record", seq.alias("seq"), F.length(seq).alias("len"))
