"""Line dedup over levelled sorted runs of line hashes (operator 1)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thylakoid.llm.common import ASCII_SPACE, ascii_lower, carried, materialize, scratch_folder

#: Lines with shorter keys (in code points) stay; keys in fewer documents stay.
LEAST_CHARS, LEAST_DOCS = 40, 5
#: Runs of one level that are merged into a run of the next; batches a corpus is cut into: the more the
#: larger it is, one for about BATCH_KEYS long lines within these bounds, since they go one by one.
FAN_IN, BATCHES, MOST_BATCHES, BATCH_KEYS = 4, 4, 64, 1 << 26


def line_key(line: Column) -> Column:
    """A line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def lines_of(text: Column) -> Column:
    """The lines of a text, cut at line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """An index of line hashes as runs in levels, filled with documents in descending order of their ids.

    A run is a table of ``h1, h2, n_docs, last_doc``, bucketed and sorted by the hash, so runs meet each
    other and a new batch bucket by bucket without being shuffled again. A batch's keys are anti-joined
    with all runs: a key that none of them has lies last in this batch, which names its last document; a
    known key lies in a larger document already and only adds to the count. So one entry of a key, over
    all runs, has a ``last_doc``. When ``fan_in`` runs have gathered on a level, they are merged into one
    run on the next, so a key is rewritten once a level and there are few runs to look into. Runs lie in
    the shared scratch folder; ``drop`` takes their tables out of the catalog.
    """

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN, folder: str | None = None):
        self.spark, self.fan_in, self.folder = spark, fan_in, folder or scratch_folder(spark)
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.tables: list[str] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def looked_up(self, keys: DataFrame) -> DataFrame:
        """The run of a batch of ``doc, h1, h2``, whose documents are smaller than all in the runs."""
        own = keys.groupBy("h1", "h2").agg(F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("last_doc"))
        fresh = own.select("h1", "h2")
        for run in self.runs():
            fresh = fresh.join(run.filter("last_doc is not null").select("h1", "h2"), ["h1", "h2"], "left_anti")
        found = own.join(fresh.withColumn("fresh", F.lit(True)), ["h1", "h2"], "left")
        return found.select("h1", "h2", "n_docs", F.when(F.col("fresh"), F.col("last_doc")).alias("last_doc"))

    def add(self, keys: DataFrame) -> DataFrame:
        """Add a batch of ``doc, h1, h2``; returns its run."""
        return self._put(self.looked_up(keys), 0)

    def _put(self, rows: DataFrame, level: int) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", f"{self.folder}/{name}").saveAsTable(name)
        self.tables.append(name)
        run = self.spark.table(name)
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_in:
            self._put(_merged(self.levels[level]), level + 1)
            self.levels[level] = []
        return run

    def counts(self) -> DataFrame:
        """Every key's documents and its largest document, over all runs."""
        return _merged(self.runs())

    def drop(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels, self.tables = [], []


def _merged(runs: list[DataFrame]) -> DataFrame:
    """Runs as one, by merge joins: counts add up; of a key's entries, one names its last document."""
    rows = runs[0]
    for run in runs[1:]:
        rows = rows.join(run.select("h1", "h2", F.col("n_docs").alias("n"), F.col("last_doc").alias("last")), ["h1", "h2"], "full")
        n = F.coalesce("n_docs", F.lit(0)) + F.coalesce("n", F.lit(0))
        rows = rows.select("h1", "h2", n.alias("n_docs"), F.least("last_doc", "last").alias("last_doc"))
    return rows


def _borders(keys: DataFrame, batches: int) -> list:
    """Ids that cut the keys into so many batches of about the same size; fewer where ids are few."""
    ids = keys.agg(F.percentile_approx("doc", [i / batches for i in range(1, batches)], 1000).alias("x")).first().x
    return sorted(set(ids or []))


def drop_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int | None = None, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Drop lines that many documents share from all of them but the one with the largest id.

    A line's key is ``line_key``. A key of at least ``least_chars`` code points found in at least
    ``least_docs`` documents loses all its lines except in the largest document id that holds it.

    Returns one row per document row: the id column, ``n_lines`` (before), ``n_dropped``, ``kept``
    (the lines that stay, joined by line feeds; empty when none stays). Null and empty texts are one
    empty line. Rows that repeat an id count as one document and are cut alike; rows with a null id are
    in no count and keep all lines. Ids must be numbers. With ``carry``, the whole input row comes along
    as the struct ``row``; else other columns aren't read.

    Documents go through ``LineRuns`` in batches of descending ids. Only hashes are shuffled to find
    repeated lines: 128 bits, the place and the id for each long line. Counting is combined before the
    shuffle, and a line that a third of all documents hold becomes a join key of one row against rows
    that AQE may split. A text is put together from the stretches between its dropped lines, so one of
    very many lines costs no more a line than others.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    tag = F.xxhash64(F.col(text_col))  # tells rows of one id apart
    place = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), tag.alias("tag"), F.posexplode(lines_of(F.col(text_col))).alias("at", "line"))
    keyed = place.withColumn("key", line_key(F.col("line"))).filter(F.length("key") >= least_chars)
    keys = materialize(keyed.select("doc", "tag", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")), folder)
    if batches is None:
        batches = min(MOST_BATCHES, max(BATCHES, keys.count() // BATCH_KEYS))
    edges = [None, *_borders(keys, batches), None]
    runs = LineRuns(spark, folder=folder)
    for low, high in reversed(list(zip(edges, edges[1:]))):
        mine = keys if low is None else keys.filter(F.col("doc") > F.lit(low))
        runs.add((mine if high is None else mine.filter(F.col("doc") <= F.lit(high))).select("doc", "h1", "h2"))
    repeated = materialize(runs.counts().filter(F.col("n_docs") >= least_docs).select("h1", "h2", "last_doc"), folder)
    runs.drop()
    doomed = keys.join(repeated, ["h1", "h2"]).filter(F.col("doc") < F.col("last_doc"))
    doomed = doomed.groupBy("doc", "tag").agg(F.sort_array(F.collect_set("at")).alias("gone"))
    body = carried(docs, True) if carry else [F.col(text_col).alias("body")]
    rows = docs.select(F.col(id_col).alias("doc"), tag.alias("tag"), *body).join(doomed, ["doc", "tag"], "left")
    lines, gone = lines_of(F.col("row")[text_col] if carry else F.col("body")), F.col("gone")
    before = F.concat(F.array(F.lit(-1)), gone)  # stretches follow the text's start and every dropped line
    stretches = F.zip_with(before, F.concat(gone, F.array(F.size(lines))), lambda a, b: F.slice(lines, a + 2, b - a - 1))
    kept = F.when(gone.isNull(), lines).otherwise(F.flatten(stretches))
    return rows.select(
        F.col("doc").alias(id_col),
        F.size(lines).cast("long").alias("n_lines"),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
        *(["row"] if carry else []),
    )
