"""Sequence expressions: each takes and returns columns, so they stay in the JVM's plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = ("A", "C", "G", "T")

#: Complements; characters outside stay.
COMPLEMENT_FROM, COMPLEMENT_TO = "ACGTacgtnN", "TGCAtgcanN"

#: Ambiguity codes and the bases they stand for.
AMBIGUITY = {
    "R": "AG", "Y": "CT", "S": "GC", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG",
}


def pseudo_sequence(text: Column) -> Column:
    """The nucleotide letters of a text, upper-cased; a stand-in for sequences in text tables."""
    return F.regexp_replace(F.upper(text), "[^ACGTN]+", "")


def revcomp(seq: Column) -> Column:
    """Reverse complement; letters other than ACGTacgtnN stay as they are."""
    return F.reverse(F.translate(seq, COMPLEMENT_FROM, COMPLEMENT_TO))


def ungap(seq: Column) -> Column:
    """Without the gap marks ``-`` and ``.``."""
    return F.translate(seq, "-.", "")


def rotate(seq: Column, cut: Column) -> Column:
    """A circular sequence from its 0-based place ``cut`` on."""
    return F.concat(F.substr(seq, cut + 1), F.substr(seq, F.lit(1), cut))


def flip_segment(seq: Column, first: Column, last: Column) -> Column:
    """With places ``first`` to ``last`` (from 1, inclusive) reverse-complemented."""
    return F.concat(
        F.substr(seq, F.lit(1), first - 1), revcomp(F.substr(seq, first, last - first + 1)), F.substr(seq, last + 1)
    )


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two sequences, over the shorter one's length; N matches anything."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x.isNull() | y.isNull() | (x == y) | (x == "N") | (y == "N"), 0).otherwise(1))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(F.aggregate(pairs, F.lit(0), lambda s, x: s + x))


def within(value: Column, reference: Column, tolerance: float = 0.1) -> Column:
    """Numeric texts within a share of the reference; false for what isn't a number, and for NaN."""
    v, r = value.try_cast("double"), reference.try_cast("double")
    return F.coalesce((F.abs(v - r) <= tolerance * F.abs(r)) & ~F.isnan(v) & ~F.isnan(r), F.lit(False))


def majority_base(a: Column, c: Column, g: Column, t: Column) -> Column:
    """The most frequent base, the first of equals in the order A, C, G, T; null if there is none."""
    most = F.greatest(a, c, g, t)
    return F.when(most <= 0, None).when(a == most, "A").when(c == most, "C").when(g == most, "G").when(t == most, "T")


#: Marks in file names and what stands for them, in the order in which they are replaced.
NAME_MARKS = (
    (r"Option_\d+_", ""),
    (r"_Novowrap.*", ""),
    (r"_pileup", ""),
    (r"\.fastq(?:\.gz)?_?", "_"),
    (r"(?i)\.(fasta|fa|fna|tsv|txt|fai)$", ""),
)


def normalized_name(name: Column) -> Column:
    """A sample's name without the marks that earlier steps add to file names, in the order given."""
    for pattern, new in NAME_MARKS:
        name = F.regexp_replace(name, pattern, new)
    return name


def record_header(hint: Column, species: Column, length: Column) -> Column:
    return F.concat(F.lit(">"), hint, F.lit(", "), species, F.lit(", "), length.cast("string"))


def one_line_record(header: Column, seq: Column) -> Column:
    """A sequence record with its whole sequence on one line."""
    return F.concat(F.when(F.startswith(header, F.lit(">")), header).otherwise(F.concat(F.lit(">"), header)), F.lit("\n"), F.regexp_replace(seq, r"\s", ""))


def composition(seq: Column) -> dict[str, Column]:
    """Counts of each base, of N and of everything else, and the length."""
    upper = F.upper(seq)
    count = {b: (F.length(seq) - F.length(F.replace(upper, F.lit(b), F.lit("")))).cast("long") for b in (*BASES, "N")}
    total = F.length(seq).cast("long")
    rest = total
    for c in count.values():
        rest = rest - c
    return {b.lower(): c for b, c in count.items()} | {"other": rest, "len": total}


def sample_base(path: Column) -> Column:
    """The sample of a mate's file: the file name without ``_1.fastq.gz`` or ``_2.fastq.gz``; else null."""
    base = F.regexp_extract(path, r"([^/]*)_[12]\.fastq\.gz$", 1)
    return F.when(base != "", base)


def version_number(name: Column, stem: str) -> Column:
    """The number in ``<stem>_<n>.fasta``, in any case; else null."""
    return F.regexp_extract(name, rf"(?i)^{stem}_(\d+)\.fasta$", 1).try_cast("int")
