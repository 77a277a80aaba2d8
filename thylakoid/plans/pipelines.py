"""Compound steps: variants from reads, corrected sequences, inversion repair."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thylakoid.functions.sequence import flip_segment, record_header, ungap
from thylakoid.operators import msa
from thylakoid.operators.alignment import smith_waterman
from thylakoid.operators.breakpoints import inversion_ends
from thylakoid.operators.kmers import bases_on_reference, best_border_match, exact_matches, map_reads, nearest_anchors, shared_kmers_of_both
from thylakoid.operators.mapping import map_gapped, pileups
from thylakoid.operators.pairing import clip_adapter, clip_palindromes, collapse_reads, pair_reads, route_pairs, trim_ends
from thylakoid.operators.pileup import apply_mutations, count_observations, mutations, variants
from thylakoid.session import cut_lineage


@dataclass(frozen=True)
class Settings:
    """The parameters of all steps and their usual values."""

    least_quality: int = 13
    least_alt: int = 3
    least_alt_share: float = 0.6
    most_ref_share: float = 0.5
    window: int = 400
    least_block: int = 2000
    least_excess: int = 8000
    k: int = 21
    anchor_k: int = 25
    seed_sizes: tuple = (27, 25, 23, 21, 19, 17)
    seed_flank: int = 1500
    anchor_flank: int = 1000
    seed_span: int = 400
    inner: int = 60
    sw_flank: int = 250
    anchor: int = 200
    most_mismatches: int = 10
    least_identity: float = 0.95
    species: str = "Hordeum vulgare"
    circular: bool = True
    ends: str = "breakpoints"
    turned_k: int = 15
    mapper: str = "gapped"


def reads_for_assembly(mates: DataFrame, adapters: str | list[str], least: int = 3, behind: tuple[str, str] | None = None) -> DataFrame:
    """What an assembler takes of all samples' reads (``sample, mate, read_idx, seq, qual``): pairs of equal
    sequences once, cut at adapters and at low-quality ends, with the ``route`` that each pair takes. With ``behind``, the
    adapters behind both mates' pieces, pairs are first cut where their mates' overlap ends."""
    side = [mates.filter(F.col("mate") == m).select("sample", "read_idx", "seq", "qual") for m in (1, 2)]
    pairs = pair_reads(*side, ["sample", "read_idx"])
    pairs = pairs.select("sample", "seq1", "seq2", F.struct("read_idx", "qual1", "qual2").alias("first"))
    once = collapse_reads(pairs, ["sample", "seq1", "seq2"], "first").select("sample", "seq1", "seq2", "first.*", "copies")
    once = clip_palindromes(once, behind) if behind else once
    for m in "12":
        once = trim_ends(clip_adapter(once, f"seq{m}", f"qual{m}", adapters), f"seq{m}", f"qual{m}", least)
    return route_pairs(once, "seq1", "seq2")


def place_reads(reads: DataFrame, contigs: DataFrame, read_key: list[str], s: Settings = Settings(), within: tuple[str, ...] = ()) -> DataFrame:
    """Reads' places on the contigs: with gaps (``map_gapped``), or by votes alone (``s.mapper`` is ``votes``; ``map_reads``)."""
    return (map_reads if s.mapper == "votes" else map_gapped)(reads, contigs, read_key, within=within)


def pileup_of(placed: DataFrame, reads: DataFrame, contigs: DataFrame, read_key: list[str], s: Settings = Settings()) -> DataFrame:
    """Placed reads as counts of each position's buckets (``chrom, pos, ref``)."""
    if "cigar" not in placed.columns:
        seen = bases_on_reference(placed, reads, contigs, read_key)
        return count_observations(seen, ["chrom", "pos", "ref"], "bucket", "quality", s.least_quality)
    return pileups(placed, reads, contigs, read_key, s.least_quality)


def variants_of(placed: DataFrame, reads: DataFrame, contigs: DataFrame, read_key: list[str], s: Settings = Settings()) -> DataFrame:
    """Placed reads -> base counts per position -> variant positions."""
    return variants(pileup_of(placed, reads, contigs, read_key, s), "ref", s.least_alt, s.least_alt_share)


def variant_table(reads: DataFrame, contigs: DataFrame, read_key: list[str], s: Settings = Settings(), within: tuple[str, ...] = ()) -> DataFrame:
    """Reads -> places -> variant positions, as one plan without files between."""
    return variants_of(place_reads(reads, contigs, read_key, s, within), reads, contigs, read_key, s)


def correct_sequences(contigs: DataFrame, found: DataFrame, key: str = "chrom", s: Settings = Settings()) -> DataFrame:
    """Contigs with the majority bases of their variant positions, and their new headers."""
    fixed = apply_mutations(contigs, mutations(found, s.most_ref_share).select(key, "pos", "base"), key)
    return fixed.withColumn("header", record_header(F.col(key), F.lit(s.species), F.length("seq")))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all shuffle partitions: aligning costs far more than the bytes by which small partitions are joined."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def valid_cut(first: Column, last: Column, length: Column, least: int) -> Column:
    """Ends (from 1) that lie in a sequence of that length, in order and far enough apart."""
    return (first >= 1) & (first < last) & (last <= length) & (last - first + 1 >= least)


def refine_cuts(rows: DataFrame, key: str, cons: str, new: str, s: Settings = Settings()) -> DataFrame:
    """Better ends for a block (``q_st, q_en`` in the new sequence, ``c_st, c_en`` in the consensus).

    In order of preference, both from what lies around the borders: maximal exact matches, the longest
    seed size that finds one; the nearest common k-mers; the ends as they are. Too short blocks keep
    their ends. The result is settled by a local alignment at both borders where that gives valid ends.
    """
    def flanks(size: int) -> DataFrame:
        def cut(seq, a, b):
            return F.substr(F.col(seq), F.greatest(a, F.lit(1)), F.greatest(b - F.greatest(a, F.lit(1)) + 1, F.lit(0)))

        left = {x: (F.col(f"{x}_st") - size, F.least(F.col(f"{x}_st") - 1 + s.inner, F.length(y))) for x, y in (("c", cons), ("q", new))}
        right = {x: (F.col(f"{x}_en") + 1 - s.inner, F.least(F.col(f"{x}_en") + size, F.length(y))) for x, y in (("c", cons), ("q", new))}
        sides = [F.struct(F.lit(name).alias("side"), cut(cons, *at["c"]).alias("c"), cut(new, *at["q"]).alias("q"), (F.greatest(at["q"][0], F.lit(1)) - 1).alias("base")) for name, at in (("left", left), ("right", right))]
        return rows.select(key, F.explode(F.array(*sides)).alias("x")).select(key, "x.*").filter((F.length("c") > 0) & (F.length("q") > 0))

    near = cut_lineage(flanks(s.seed_flank))
    inside = F.when(F.col("side") == "left", F.col("b0") + F.col("size") > F.length("q") - s.seed_span).otherwise(F.col("b0") <= s.seed_span)
    matches = cut_lineage(exact_matches(near, [key, "side"], "c", "q", min(s.seed_sizes)).join(near.select(key, "side", "q", "base"), [key, "side"]).filter(inside))
    # the largest seed size that a match of the flank holds, then the longest of those, which is the longest of all
    ends = None
    for side in ("left", "right"):
        best = best_border_match(matches.filter(F.col("side") == side), [key, "base"], side)
        place = F.col("base") + F.col("b0") + (F.col("size") + 1 if side == "left" else 0)
        one = best.select(key, place.cast("int").alias(f"m_{side}"))
        ends = one if ends is None else ends.join(one, key, "full")
    plain = flanks(s.anchor_flank)
    simple = nearest_anchors(plain, [key, "side"], "c", "q", s.anchor_k).join(plain.select(key, "side", "base"), [key, "side"])
    simple = simple.groupBy(key).agg(F.max(F.when(F.col("side") == "left", F.col("base") + F.col("left") + s.anchor_k + 1)).alias("a_left"), F.max(F.when(F.col("side") == "right", F.col("base") + F.col("right"))).alias("a_right"))
    out = cut_lineage(spread(rows.join(ends, key, "left").join(simple, key, "left"), key))

    def valid(a, b, least):
        return valid_cut(a, b, F.length(new), least)

    tries = []
    for left, right, name, least in (("m_left", "m_right", "matches", max(500, min(s.seed_sizes) * 5)), ("a_left", "a_right", "anchors", max(500, s.anchor_k * 5))):
        a, b = F.coalesce(F.col(left), F.col("q_st")), F.coalesce(F.col(right), F.col("q_en"))
        tries.append(F.when((F.col(left).isNotNull() | F.col(right).isNotNull()) & valid(a, b, least), F.struct(a.cast("int").alias("st"), b.cast("int").alias("en"), F.lit(name).alias("by"))))
    base = F.struct(F.col("q_st").cast("int").alias("st"), F.col("q_en").cast("int").alias("en"), F.lit("block").alias("by"))
    out = out.withColumn("cut", F.coalesce(*tries, base))
    w = s.sw_flank
    ql, qr = F.greatest(F.col("cut.st") - w, F.lit(1)), F.greatest(F.col("cut.en") + 1 - s.inner, F.lit(1))
    left = smith_waterman(F.substr(F.col(cons), F.greatest(F.col("c_st") - w, F.lit(1)), F.lit(w + s.inner)), F.substr(F.col(new), ql, F.lit(w + s.inner)))
    right = smith_waterman(F.substr(F.col(cons), F.greatest(F.col("c_en") + 1 - s.inner, F.lit(1)), F.lit(w + s.inner)), F.substr(F.col(new), qr, F.lit(w + s.inner)))
    out = out.withColumns({"_l": left, "_r": right})
    st, en = ql + F.col("_l.b_en"), qr + F.col("_r.b_st") - 2
    settled = F.col("_l.score").isNotNull() & F.col("_r.score").isNotNull() & valid(st, en, 200)
    return out.select(key, F.when(settled, st).otherwise(F.col("cut.st")).alias("first"), F.when(settled, en).otherwise(F.col("cut.en")).alias("last"), F.when(settled, "local alignment").otherwise(F.col("cut.by")).alias("by"))


def repair_inversions(aligned: DataFrame, key: str, s: Settings = Settings()) -> DataFrame:
    """Sequences with their inverted segment turned back, if that makes them no less like the consensus.

    ``aligned`` has ``key, cons, new`` of equal length with gaps. A block that looks inverted tells that there is a segment and
    where; its ends are those that gain most matches (``s.ends`` is ``breakpoints``) or come from anchors around
    the block's borders (``anchors``, ``refine_cuts``). Where turned k-mers don't tell a segment, the block's ends hold. Returns one row
    each: ``seq`` without gaps, the ends, ``flipped`` and both similarities. Rows without a block are unchanged.
    """
    rows = cut_lineage(spread(aligned.select(key, F.upper("cons").alias("cons"), F.upper("new").alias("new")), key))
    blocks = cut_lineage(msa.inversion_block(rows, [key], s.window, s.least_block, s.least_excess, "new", "cons"))
    query = msa.span_in_query(rows, blocks, [key], "new")
    bare = rows.select(key, ungap(F.col("cons")).alias("cons"), ungap(F.col("new")).alias("new"))
    if s.ends == "anchors":
        target = msa.span_in_query(rows, blocks, [key], "cons").select(key, F.col("q_st").alias("c_st"), F.col("q_en").alias("c_en"))
        cuts = refine_cuts(cut_lineage(spread(bare.join(query, key).join(target, key), key)), key, "cons", "new", s)
    else:
        near = spread(rows.join(query, key), key).withColumns({"_st": F.greatest(F.col("q_st") - s.window, F.lit(1)), "_en": F.col("q_en") + s.window})
        ends = inversion_ends(near, [key, "q_st", "q_en"], k=s.turned_k, first="_st", last="_en")
        by = F.when(F.col("gain").isNull(), "block").otherwise("breakpoints").alias("by")
        cuts = cut_lineage(ends.select(key, F.coalesce("first_place", "q_st").alias("first"), F.coalesce("last_place", "q_en").alias("last"), by))
    flip = spread(bare.join(cuts, key), key).withColumn("turned", flip_segment(F.col("new"), F.col("first"), F.col("last")))
    score = [F.when(F.col(f"_n.total_{x}") > 0, F.col(f"_n.shared_{x}") / F.col(f"_n.total_{x}")).otherwise(0.0).alias(n) for x, n in (("a", "before"), ("b", "after"))]
    judged = flip.select(key, "turned", "first", "last", "by", shared_kmers_of_both(s.k)("cons", "new", "turned").alias("_n")).select(key, "turned", "first", "last", "by", *score)
    better = F.col("after") >= F.col("before")
    return bare.join(judged, key, "left").select(key, F.when(better, F.col("turned")).otherwise(F.col("new")).alias("seq"), "first", "last", "by", F.coalesce(better, F.lit(False)).alias("flipped"), "before", "after")
