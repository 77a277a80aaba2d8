"""Growing alignments: samples are added one by one, columns open in all rows, versions stay readable.

A store is a Parquet table of one row for each sample: the row as it was aligned, the version that added it, the columns
that it opened (``gaps``), and the base counts of all columns after it. Adding a sample writes its row; no
earlier row is written again. A store holds the alignments of any number of families (kinds of genomes), which grow side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thylakoid.functions.sequence import AMBIGUITY, BASES, ungap
from thylakoid.operators import gapmap, msa
from thylakoid.operators.alignment import align_pair, rotate_to_anchor
from thylakoid.operators.pileup import mutations
from thylakoid.plans.pipelines import Settings, correct_sequences, place_reads, repair_inversions, spread, variants_of
from thylakoid.session import cut_lineage, drop_scratch, free_shuffles

#: Letters that a sequence may have.
LETTERS = [*BASES, *AMBIGUITY, "N"]

_COLUMNS = ["family", "row_ord", "header", "seq_aln", "gaps", "width", "counts"]


def start_alignments(store: str, references: DataFrame) -> None:
    """A new store with one reference (``family, header, seq``) for each family, as version 0."""
    rows = references.select("family", F.lit(0).cast("long").alias("row_ord"), "header", F.upper("seq").alias("seq_aln"))
    rows = rows.withColumns({"gaps": F.array().cast(gapmap.GAPS), "width": F.length("seq_aln"), "counts": gapmap.profile_of("seq_aln")})
    _append(rows, store, 0)


def _append(rows: DataFrame, store: str, version: int) -> None:
    rows.select(*_COLUMNS, F.lit(version).alias("version")).write.mode("append").partitionBy("version").parquet(store)


def rows_at(spark: SparkSession, store: str, version: int | None = None, more: DataFrame | None = None) -> DataFrame:
    """All rows (``family, row_ord, header, seq_aln``) in the columns of a version, the last one if none is given.

    ``more`` (as rows of the store, of later versions) comes along: for alignments that were rejected.
    """
    rows = spark.read.parquet(store)
    rows = (rows if version is None else rows.filter(F.col("version") <= version)).select("family", "version", "row_ord", "header", "seq_aln", "gaps", "width")
    rows = rows if more is None else rows.unionByName(more.select(rows.columns))
    later = gapmap.later_gaps(rows, ["family"])
    opened = rows.join(later, ["family", "version"]).withColumn("seq_aln", gapmap.open_columns("seq_aln", "later"))
    return opened.select("family", "row_ord", "header", "seq_aln")


def add_samples(spark: SparkSession, store: str, samples: DataFrame, s: Settings = Settings(), rejected: str | None = None) -> DataFrame:
    """Add one sample (``family, header, seq``) to each of some families.

    A sample is turned to its family's first row's start (if ``s.circular``), aligned to the consensus, repaired where a segment
    is inverted and then aligned again. Letters that the consensus lacks open columns in all rows, so no letter of any row is ever lost.
    Returns ``family, header, compared, equal, identity, status``: ``accepted``; ``rejected``, where fewer letters than ``s.least_identity``
    equal the consensus (kept in the table ``rejected``, if given, in the same form); ``empty``, without a sequence; ``no family``, without a
    reference. All families are done side by side; one sample a family a call, since each acceptance changes what the next is compared with.
    """
    stored = spark.read.parquet(store)
    last = stored.groupBy("family").agg(F.max("version").alias("version"), F.count("*").alias("rows"))
    newest = stored.select("family", "version", "counts").join(last, ["family", "version"])
    known = cut_lineage(newest.select("family", "rows", "counts", gapmap.packed_consensus("counts").alias("cons")))
    first = stored.filter("row_ord = 0").select("family", ungap(F.col("seq_aln")).alias("ref"))
    new = cut_lineage(samples.select("family", "header", F.upper(F.coalesce("seq", F.lit(""))).alias("seq")))
    sound = new.filter("seq <> ''").join(first, "family")
    version = stored.agg(F.max("version")).first()[0] + 1

    turned = rotate_to_anchor(sound, ["family"], "ref", "seq", s.anchor, s.most_mismatches, s.k).select("family", "seq") if s.circular else sound.select("family", "seq")

    def aligned(seqs: DataFrame) -> DataFrame:
        pair = spread(seqs.join(known.select("family", "cons"), "family"), "family").select("family", align_pair("cons", "seq").alias("p"))
        return cut_lineage(pair.select("family", F.col("p.a").alias("cons"), F.col("p.b").alias("new")))

    once = aligned(turned)
    repaired = cut_lineage(repair_inversions(once, "family", s).filter("flipped").select("family", "seq"))
    pairs = once.join(repaired, "family", "left_anti").unionByName(aligned(repaired))
    # columns that only the sample has are compared with nothing
    scored = msa.route_by_identity(msa.identity(pairs.withColumn("cons", F.translate("cons", "-", "N")), ["family"], "new"), s.least_identity)
    grown = pairs.join(known.drop("cons"), "family").join(new.select("family", "header"), "family")
    grown = grown.withColumns({"gaps": gapmap.gaps_of("cons"), "seq_aln": F.col("new"), "width": F.length("new"), "row_ord": F.col("rows")})
    grown = grown.withColumn("counts", gapmap.grown_profile("counts", "gaps", "new"))
    grown = cut_lineage(grown.join(scored, "family").withColumn("version", F.lit(version)).drop("rows", "cons", "new"))
    _append(grown.filter("status = 'accepted'"), store, version)
    if rejected:
        grown.filter("status = 'rejected'").select(*_COLUMNS, "version").write.mode("append").parquet(rejected)
    why = F.when(F.col("seq") == "", "empty").when(F.col("status").isNull(), "no family").otherwise(F.col("status"))
    judged = new.join(grown.select("family", "compared", "equal", "identity", "status"), "family", "left")
    return cut_lineage(judged.select("family", "header", "compared", "equal", "identity", why.alias("status")))


def run_samples(spark: SparkSession, mates: DataFrame, contigs: DataFrame, references: DataFrame, store: str, s: Settings = Settings(), rejected: str | None = None) -> DataFrame:
    """From reads (``sample, mate, read_idx, seq, qual``) and one assembled contig a sample (``sample, family, seq``) to
    the alignments of all families (``references``: ``family, header, seq``, which begin a new ``store``).

    Returns one row for each sample and stage that it reached: ``sample, stage, status, amount``. Stages: ``input``
    (``ok``, ``no reads``, ``no contig``, ``several contigs``, ``empty contig``, ``bad letters``, ``no family``; amount: reads), ``mapping`` (``ok`` or
    ``no reads mapped``; reads mapped), ``correction`` (``ok``; positions changed) and ``alignment`` (as ``add_samples`` says; identity). A sample that
    fails a stage takes no part in later ones and others go on; one without mapped reads is aligned uncorrected.

    Reads of all samples are mapped to their own sample's contig and the contigs corrected at once; then each family takes its samples
    in their order, one a round, since each decision depends on those before. Reads are mapped as they were read; ``reads_for_assembly``
    makes the assembler's.
    """
    reads = mates.select("sample", "mate", "read_idx", "seq", "qual")
    with_reads = reads.groupBy("sample").agg(F.count("*").alias("reads"))
    held = contigs.groupBy("sample").agg(F.count("*").alias("contigs"), F.first("family").alias("family"), F.first("seq").alias("seq"))
    families = references.select("family", F.lit(True).alias("known"))
    every = held.join(with_reads, "sample", "full").join(families, "family", "left")
    status = F.when(F.col("contigs").isNull(), "no contig").when(F.col("contigs") > 1, "several contigs").when(F.col("reads").isNull(), "no reads")
    status = status.when(F.trim(F.coalesce("seq", F.lit(""))) == "", "empty contig").when(F.upper("seq").rlike(f"[^{''.join(LETTERS)}]"), "bad letters")
    every = cut_lineage(every.withColumn("status", status.when(F.col("known").isNull(), "no family").otherwise("ok")))
    good = every.filter("status = 'ok'")
    own = good.select("sample", F.col("sample").alias("chrom"), "seq")
    placed = cut_lineage(place_reads(reads.join(good.select("sample"), "sample", "left_semi"), own, ["sample", "mate", "read_idx"], s, within=("sample",)))
    mapped = cut_lineage(placed.groupBy("sample").agg(F.count("*").alias("n")))
    free_shuffles(spark)
    found = cut_lineage(variants_of(placed, reads, own, ["sample", "mate", "read_idx"], s))
    drop_scratch(placed)
    free_shuffles(spark)
    fixed = cut_lineage(correct_sequences(own.drop("sample"), found, s=s).join(good.select(F.col("sample").alias("chrom"), "family"), "chrom"))
    changed = mutations(found, s.most_ref_share).groupBy(F.col("chrom").alias("sample")).agg(F.count_distinct("pos").alias("n"))
    stage = lambda rows, name, status, amount: rows.select("sample", F.lit(name).alias("stage"), status.alias("status"), amount.cast("double").alias("amount"))
    counted = lambda n: good.select("sample").join(n, "sample", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    out = stage(every, "input", F.col("status"), F.coalesce("reads", F.lit(0)))
    out = out.unionByName(stage(counted(mapped), "mapping", F.when(F.col("n") > 0, "ok").otherwise("no reads mapped"), F.col("n")))
    out = out.unionByName(stage(counted(changed), "correction", F.lit("ok"), F.col("n")))

    start_alignments(store, references)
    turn = F.row_number().over(Window.partitionBy("family").orderBy("chrom"))
    queued = cut_lineage(fixed.withColumn("turn", turn))
    made = []
    for i in range(1, (queued.agg(F.max("turn")).first()[0] or 0) + 1):
        now = queued.filter(F.col("turn") == i)
        made.append(add_samples(spark, store, now, s, rejected).join(now.select("family", F.col("chrom").alias("sample")), "family"))
        free_shuffles(spark)
    for decisions in made:
        out = out.unionByName(stage(decisions, "alignment", F.col("status"), F.col("identity")))
    return cut_lineage(out)
