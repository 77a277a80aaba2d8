"""Registered queries: each runs an operator over whole given tables, with the same result in SQL.

Text tables stand in for genomic ones: a document's nucleotide letters are its sequence, a source's
documents are one alignment, events are observations at positions, conversations are mates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thylakoid.functions import sequence as fx
from thylakoid.operators import alignment, gapmap, kmers, mapping, msa, pairing, pileup, selection
from thylakoid.plans import growing, pipelines
from thylakoid.session import cut_lineage, read_table, scratch_folder
from thylakoid.sources import alignments
from thylakoid.sources import files as sources

QUERIES: dict = {}
SQL: dict = {}

#: A document's nucleotide letters, as SQL.
_SEQ = "regexp_replace(upper(text), '[^ACGTN]', '', 'g')"
_DOCS = f"docs AS (SELECT doc_id, source, {_SEQ} AS seq FROM documents)"
_COMPLEMENT = "reverse(translate({}, 'ACGTacgtnN', 'TGCAtgcanN'))"


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def _sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "source", fx.pseudo_sequence(F.col("text")).alias("seq"))


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the next one by id."""
    docs = _sequences(spark, sf_dir)
    return docs.select("doc_id", F.col("seq").alias("a")).join(docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("seq").alias("b")), "doc_id")


# --- mates and reads -------------------------------------------------------------------------


@query("""
SELECT 'c' || conv_id AS sample, 'c' || conv_id || '_1.fastq.gz' AS r1_path, 'c' || conv_id || '_2.fastq.gz' AS r2_path
FROM conversations GROUP BY conv_id HAVING bool_or(role = 'user') AND bool_or(role = 'assistant')
""")
def pair_files(spark, sf_dir):
    mate = F.when(F.col("role") == "user", "1").when(F.col("role") == "assistant", "2")
    rows = read_table(spark, sf_dir, "conversations").select(F.concat(F.lit("c"), "conv_id", F.lit("_"), mate, F.lit(".fastq.gz")).alias("path")).dropna()
    return pairing.pair_files(rows)


@query("SELECT conv_id, role, min(turn) AS turn FROM conversations GROUP BY conv_id, role")
def pair_dedup(spark, sf_dir):
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "role", "turn")
    return pairing.first_of_each_pair(rows.unionByName(rows), ["conv_id", "role"], "turn")


@query("""
WITH r AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS read_idx FROM conversations)
SELECT a.conv_id, a.read_idx, length(a.text) AS len1, length(b.text) AS len2
FROM r a JOIN r b ON a.conv_id = b.conv_id AND a.read_idx = b.read_idx WHERE a.role = 'user' AND b.role = 'assistant'
""")
def read_pairs(spark, sf_dir):
    rows = pairing.numbered(read_table(spark, sf_dir, "conversations"), ["conv_id", "role"], ["turn"], "read_idx")
    rows = rows.select("conv_id", F.col("read_idx").cast("long").alias("read_idx"), "role", F.length("text").cast("long").alias("len"))
    one, two = (rows.filter(F.col("role") == r).drop("role") for r in ("user", "assistant"))
    return pairing.pair_reads(one, two, ["conv_id", "read_idx"])


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def exact_dedup(spark, sf_dir):
    return pairing.collapse_reads(read_table(spark, sf_dir, "documents"), ["text"], "doc_id").select("doc_id", "copies")


@query("SELECT doc_id, regexp_replace(regexp_replace(text, '^[^A-Za-z]+', ''), '[^A-Za-z]+$', '') AS seq FROM documents")
def trim_ends(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").withColumnRenamed("text", "seq")
    docs = docs.withColumn("qual", F.regexp_replace(F.regexp_replace("seq", "[A-Za-z]", "I"), "[^I]", "!"))
    return pairing.trim_ends(docs, "seq", "qual").select("doc_id", "seq")


@query(f"""
WITH {_DOCS}, cut AS (SELECT doc_id, seq, CASE WHEN instr(seq, 'ATTACAT') > 0 THEN instr(seq, 'ATTACAT') - 1 WHEN ends_with(seq, 'ATTACA') THEN length(seq) - 6
  WHEN ends_with(seq, 'ATTAC') THEN length(seq) - 5 WHEN ends_with(seq, 'ATTA') THEN length(seq) - 4 ELSE length(seq) END AS n FROM docs)
SELECT doc_id, substr(seq, 1, n) AS seq FROM cut
""")
def clip_adapter(spark, sf_dir):
    docs = _sequences(spark, sf_dir).withColumn("qual", F.col("seq"))
    return pairing.clip_adapter(docs, "seq", "qual", "ATTACAT", 4).select("doc_id", "seq")


@query("""
WITH p AS (SELECT conv_id, max(text) FILTER (role = 'user') AS one, max(text) FILTER (role = 'system') AS two FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN coalesce(one, '') <> '' AND coalesce(two, '') <> '' THEN 'paired' WHEN coalesce(one, '') <> '' THEN 'unpaired_1' WHEN coalesce(two, '') <> '' THEN 'unpaired_2' ELSE 'dropped' END AS route FROM p
""")
def trim_pair_route(spark, sf_dir):
    role = lambda r: F.max(F.when(F.col("role") == r, F.col("text")))
    pairs = read_table(spark, sf_dir, "conversations").groupBy("conv_id").agg(role("user").alias("one"), role("system").alias("two"))
    return pairing.route_pairs(pairs, "one", "two").select("conv_id", "route")


# --- selection -------------------------------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE abs(l_extendedprice / l_quantity - p_retailprice) <= 0.1 * abs(p_retailprice)
""")
def within_tolerance(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").join(read_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    near = fx.within(F.col("l_extendedprice") / F.col("l_quantity"), F.col("p_retailprice"))
    return lines.filter(near).select("l_orderkey", "l_linenumber", "l_partkey")


_METRICS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _mean(column: str):
    """The mean of hundredths, whose sum doesn't depend on the order of rows."""
    return F.sum(F.round(F.col(column) * 100).cast("long")) / (F.count("*") * 100)


@query("""
WITH m AS (SELECT l_partkey, sum(CAST(round(l_quantity * 100) AS BIGINT)) / (count(*) * 100) AS q, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / (count(*) * 100) AS e, sum(CAST(round(l_discount * 100) AS BIGINT)) / (count(*) * 100) AS d, sum(CAST(round(l_tax * 100) AS BIGINT)) / (count(*) * 100) AS t FROM lineitem GROUP BY l_partkey),
ok AS (SELECT l.* FROM lineitem l JOIN m USING (l_partkey) WHERE (abs(l_quantity - q) <= 0.1 * abs(q))::INT + (abs(l_extendedprice - e) <= 0.1 * abs(e))::INT + (abs(l_discount - d) <= 0.1 * abs(d))::INT + (abs(l_tax - t) <= 0.1 * abs(t))::INT >= 3)
SELECT l_partkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) AS n FROM ok) WHERE n = 1
""")
def k_of_n_select(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", *_METRICS)
    means = lines.groupBy("l_partkey").agg(*[_mean(c).alias(f"mean_{c}") for c in _METRICS])
    good = selection.passes(lines.join(means, "l_partkey"), None, [(c, f"mean_{c}") for c in _METRICS])
    return selection.first_per_group(good.select("l_partkey", "l_orderkey", "l_linenumber"), ["l_partkey"], ["l_orderkey", "l_linenumber"])


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def failed_groups(spark, sf_dir):
    customers = read_table(spark, sf_dir, "customer").select("c_custkey")
    large = read_table(spark, sf_dir, "orders").filter("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return selection.split_by_success(customers, large, "c_custkey")[1]


@query("""
SELECT o_custkey, o_orderdate, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1
""")
def latest_per_sample(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return selection.latest_per_group(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def _page_files(spark, sf_dir):
    url = F.col("url")
    return read_table(spark, sf_dir, "pages").select(F.regexp_extract(url, "://([^/]+)", 1).alias("folder"), F.regexp_extract(url, "://[^/]+/([^?#]*)", 1).alias("name"))


@query("""
WITH f AS (SELECT regexp_extract(url, '://([^/]+)', 1) AS folder, regexp_extract(url, '://[^/]+/([^?#]*)', 1) AS name FROM pages),
i AS (SELECT DISTINCT folder, split_part(name, '.', 1) AS stem FROM f)
SELECT folder, stem, coalesce(max(name) FILTER (name = stem || '.html'), min(name)) AS file FROM i JOIN f USING (folder) WHERE starts_with(name, stem) GROUP BY folder, stem
""")
def prefix_match_fallback(spark, sf_dir):
    files = _page_files(spark, sf_dir)
    inputs = files.select("folder", F.substring_index("name", ".", 1).alias("stem")).distinct()
    return selection.match_files(inputs, files, "folder", "stem", "name", ".html")


@query("""
WITH m AS (SELECT 'p' || l_partkey AS folder, 'line' || l_orderkey AS input, l_orderkey * 10 + l_linenumber AS row_ord, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem),
a AS (SELECT folder, sum(CAST(round(l_quantity * 100) AS BIGINT)) / (count(*) * 100) AS q, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / (count(*) * 100) AS e, sum(CAST(round(l_discount * 100) AS BIGINT)) / (count(*) * 100) AS d, sum(CAST(round(l_tax * 100) AS BIGINT)) / (count(*) * 100) AS t FROM m GROUP BY folder),
ok AS (SELECT m.* FROM m JOIN a USING (folder) WHERE (abs(l_quantity - q) <= 0.1 * abs(q)) AND (abs(l_quantity - q) <= 0.1 * abs(q))::INT + (abs(l_extendedprice - e) <= 0.1 * abs(e))::INT + (abs(l_discount - d) <= 0.1 * abs(d))::INT + (abs(l_tax - t) <= 0.1 * abs(t))::INT >= 3),
one AS (SELECT folder, min(row_ord) AS row_ord FROM ok GROUP BY folder)
SELECT DISTINCT folder, input, row_ord, input || '.fasta' AS file FROM one JOIN m USING (folder, row_ord)
""")
def select_assemblies(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem")
    means = lines.groupBy("l_partkey").agg(*[_mean(c).alias(f"mean_{c}") for c in _METRICS])
    named = dict(zip(("LSC", "IRa", "SSC", "IRb"), _METRICS))
    rows = lines.join(means, "l_partkey").select(
        F.concat(F.lit("p"), "l_partkey").alias("folder"), F.concat(F.lit("line"), "l_orderkey").alias("Input"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_ord"),
        F.col("l_quantity").alias("Length"), F.col("mean_l_quantity").alias("Ref_length"),
        *[F.col(c).alias(n) for n, c in named.items()], *[F.col(f"mean_{c}").alias(f"r_{n}") for n, c in named.items()],
    )
    files = rows.select("folder", F.concat("Input", F.lit(".fasta")).alias("name"))
    return selection.select_assemblies(rows, files)[0].select("folder", F.col("Input").alias("input"), "row_ord", "file")


# --- names and records -----------------------------------------------------------------------


@query(r"""
WITH n AS (SELECT page_id, 'Option_' || page_id || '_' || regexp_extract(url, '://[^/]+/([^?#]*)', 1) || '.fastq.gz_' || page_id || '_pileup.tsv' AS name FROM pages)
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(name, 'Option_\d+_', '', 'g'), '_Novowrap.*', '', 'g'), '_pileup', '', 'g'), '\.fastq(?:\.gz)?_?', '_', 'g'), '(?i)\.(fasta|fa|fna|tsv|txt|fai)$', '') AS name FROM n
""")
def normalize_name(spark, sf_dir):
    rows = read_table(spark, sf_dir, "pages")
    name = F.concat(F.lit("Option_"), "page_id", F.lit("_"), F.regexp_extract("url", "://[^/]+/([^?#]*)", 1), F.lit(".fastq.gz_"), "page_id", F.lit("_pileup.tsv"))
    return rows.select("page_id", fx.normalized_name(name).alias("name"))


@query(r"SELECT doc_id, '>' || source || e'\n' || regexp_replace(text, '\s', '', 'g') AS record FROM documents".replace(r"e'\n'", "chr(10)"))
def fasta_oneline(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", fx.one_line_record(F.col("source"), F.col("text")).alias("record"))


@query("SELECT doc_id, '>' || source || ', Hordeum vulgare, ' || length(text) AS header FROM documents")
def header_rename(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", fx.record_header(F.col("source"), F.lit("Hordeum vulgare"), F.length("text")).alias("header"))


@query("SELECT coalesce(max(try_cast(regexp_extract('Set_' || o_orderkey || '.FASTA', '(?i)^Set_(\\d+)\\.fasta$', 1) AS INT)), 0) + 1 AS version FROM orders")
def next_version(spark, sf_dir):
    names = read_table(spark, sf_dir, "orders").select(F.concat(F.lit("Set_"), "o_orderkey", F.lit(".FASTA")).alias("name"))
    return sources.next_version(names, "Set")


# --- files: written from the tables to the shared scratch folder, and read again --------------


@query(f"WITH {_DOCS} SELECT '>d' || doc_id AS header, seq, CAST(length(seq) AS INT) AS len FROM docs")
def fasta_files(spark, sf_dir):
    folder = scratch_folder(spark)
    sources.write_fasta(_sequences(spark, sf_dir).select(F.concat(F.lit("d"), "doc_id").alias("header"), "seq"), folder)
    return sources.read_fasta(spark, folder).select("header", "seq", "len")


@query(f"""
WITH {_DOCS} SELECT source, '>d' || doc_id AS header, seq FROM docs WHERE source IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1
""")
def first_records(spark, sf_dir):
    folder = scratch_folder(spark)
    # a folder's name that any source can have; it can't be null, so the writer keeps the order of these rows and adds no sort of its own
    place = F.coalesce(F.concat(F.lit("s"), F.hex("source")), F.lit(""))
    rows = _sequences(spark, sf_dir).filter("source is not null").withColumn("place", place)
    lines = rows.repartition("place").sortWithinPartitions("place", "doc_id")
    lines.select("place", fx.one_line_record(F.concat(F.lit("d"), "doc_id"), F.col("seq")).alias("value")).write.partitionBy("place").text(folder)
    found = sources.read_first_record(spark, f"{folder}/*/*.txt")
    return found.select(F.decode(F.unhex(F.regexp_extract("file", "place=s([^/]*)/", 1)), "UTF-8").alias("source"), "header", "seq")


@query("SELECT 'r' || conv_id || '.' || turn AS name, regexp_replace(text, '\\s', '', 'g') AS seq, repeat('I', length(regexp_replace(text, '\\s', '', 'g'))) AS qual FROM conversations")
def fastq_files(spark, sf_dir):
    folder = f"{scratch_folder(spark)}/reads_1.fastq"
    rows = read_table(spark, sf_dir, "conversations").select(F.concat(F.lit("r"), "conv_id", F.lit("."), "turn").alias("name"), F.regexp_replace("text", r"\s", "").alias("seq"))
    sources.write_fastq(rows.withColumn("qual", F.repeat(F.lit("I"), F.length("seq"))), folder)
    return sources.read_fastq(spark, folder, 1).select("name", "seq", "qual")


@query("""
SELECT 'line' || l_orderkey || '.' || l_linenumber AS "Input", CAST(CAST(l_quantity AS INT) AS VARCHAR) AS "Length", CAST(l_partkey AS VARCHAR) AS "LSC",
  CASE WHEN l_orderkey % 2 = 0 THEN CAST(l_suppkey AS VARCHAR) END AS "SSC" FROM lineitem
""")
def metrics_files(spark, sf_dir):
    folder = scratch_folder(spark)
    lines = read_table(spark, sf_dir, "lineitem")
    rows = lines.select("l_orderkey", F.concat(F.lit("line"), "l_orderkey", F.lit("."), "l_linenumber").alias("Input"), F.col("l_quantity").cast("int").alias("Length"), F.col("l_partkey").alias("LSC"), F.col("l_suppkey").alias("SSC"))
    rows.filter("l_orderkey % 2 = 0").select("SSC", "Input", "Length", "LSC").write.option("header", True).csv(f"{folder}/even")
    rows.filter("l_orderkey % 2 <> 0").select("LSC", "Length", "Input").write.option("header", True).csv(f"{folder}/odd")
    return sources.read_metrics(spark, folder, ["Input", "Length", "LSC", "SSC"]).drop("folder", "row_ord")


@query("""
SELECT 'f/c' || conv_id || '_1.fastq.gz' AS r1_path, 'f/c' || conv_id || '_2.fastq.gz' AS r2_path FROM conversations GROUP BY conv_id
""")
def pair_list_files(spark, sf_dir):
    folder = scratch_folder(spark)
    base = F.concat(F.lit("f/c"), F.col("conv_id"))
    pairs = read_table(spark, sf_dir, "conversations").select("conv_id").distinct()
    sources.write_pair_list(pairs.select(F.concat(base, F.lit("_1.fastq.gz")).alias("r1_path"), F.concat(base, F.lit("_2.fastq.gz")).alias("r2_path")), folder)
    return sources.read_pair_list(spark, folder)


@query("""
WITH f AS (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) || CASE WHEN page_id % 3 = 0 THEN '.txt' ELSE '.fasta' END AS name FROM pages)
SELECT page_id, name FROM f WHERE contains(name, '1') AND ends_with(name, '.fasta')
""")
def files_named(spark, sf_dir):
    name = F.concat(F.regexp_extract("url", "([^/]*)$", 1), F.when(F.col("page_id") % 3 == 0, ".txt").otherwise(".fasta"))
    return sources.files_named(read_table(spark, sf_dir, "pages").select("page_id", name.alias("name")), "1")


@query(f"""
WITH {_DOCS}, r AS (SELECT 'd' || doc_id AS record, length(seq) AS n FROM docs WHERE length(seq) >= 12)
SELECT record, 0 AS feature_id, 'source' AS key, 1 AS strand, 1 AS parts, CAST(n AS BIGINT) AS covered, CAST(NULL AS VARCHAR) AS gene, CAST(n AS INT) AS len FROM r
UNION ALL SELECT record, 1, 'gene', -1, 2, 3 + n // 2 - 5, 'g ' || record || ' of many', n FROM r UNION ALL SELECT record, 2, 'CDS', 0, 2, 5, NULL, n FROM r
""")
def annotation_files(spark, sf_dir):
    folder = scratch_folder(spark)
    docs = _sequences(spark, sf_dir).filter("length(seq) >= 12").select(F.concat(F.lit("d"), "doc_id").alias("record"), F.length("seq").alias("n"), F.lower("seq").alias("seq"))
    half = F.expr("cast(n div 2 as string)")
    record = F.concat(
        F.lit("LOCUS       "), "record", F.lit(" bp\nFEATURES             Location/Qualifiers\n     source          1.."), F.col("n").cast("string"),
        F.lit("\n     gene            complement(join(1..3,\n                     6.."), half, F.lit('))\n                     /gene="g '), "record", F.lit(' of\n                     many"\n     CDS             join(complement(1..2),4..6)\nORIGIN\n        1 '), "seq", F.lit("\n//"),
    )
    docs.select(record.alias("value")).write.text(folder)
    features, seqs = sources.read_genbank(spark, folder)
    covered = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["e"] - p["s"] + 1)
    rows = features.select("record", "feature_id", "key", "strand", F.size("parts").alias("parts"), covered.alias("covered"), F.try_element_at(F.col("quals")["gene"], F.lit(1)).alias("gene"))
    return rows.join(seqs.select("record", "len"), "record")


# --- sequences -------------------------------------------------------------------------------


@query(f"""
WITH {_DOCS} SELECT doc_id, length(seq) - length(replace(seq, 'A', '')) AS a, length(seq) - length(replace(seq, 'C', '')) AS c, length(seq) - length(replace(seq, 'G', '')) AS g,
  length(seq) - length(replace(seq, 'T', '')) AS t, length(seq) - length(replace(seq, 'N', '')) AS n, length(text) - length(seq) AS other, length(text) AS len FROM docs JOIN documents USING (doc_id)
""")
def base_composition(spark, sf_dir):
    seq = fx.pseudo_sequence(F.col("text"))
    counts = fx.composition(seq)
    counts["other"] = (F.length("text") - F.length(seq)).cast("long")
    counts["len"] = F.length("text").cast("long")
    return read_table(spark, sf_dir, "documents").select("doc_id", *[c.alias(n) for n, c in counts.items()])


@query(f"WITH {_DOCS} SELECT doc_id, {_COMPLEMENT.format('seq')} AS seq FROM docs")
def revcomp(spark, sf_dir):
    return _sequences(spark, sf_dir).select("doc_id", fx.revcomp(F.col("seq")).alias("seq"))


@query(f"WITH {_DOCS} SELECT doc_id, substr(seq, length(seq) // 3 + 1) || substr(seq, 1, length(seq) // 3) AS seq FROM docs")
def rotate(spark, sf_dir):
    return _sequences(spark, sf_dir).select("doc_id", fx.rotate(F.col("seq"), F.expr("int(length(seq) div 3)")).alias("seq"))


@query(f"""
WITH {_DOCS}, c AS (SELECT *, length(seq) // 4 + 1 AS a, length(seq) // 2 AS b FROM docs)
SELECT doc_id, substr(seq, 1, a - 1) || {_COMPLEMENT.format("substr(seq, a, b - a + 1)")} || substr(seq, b + 1) AS seq FROM c WHERE length(seq) >= 4
""")
def flip_segment(spark, sf_dir):
    first, last = F.expr("int(length(seq) div 4) + 1"), F.expr("int(length(seq) div 2)")
    return _sequences(spark, sf_dir).filter("length(seq) >= 4").select("doc_id", fx.flip_segment(F.col("seq"), first, last).alias("seq"))


@query(f"""
WITH {_DOCS}, p AS (SELECT a.doc_id, a.seq AS a, b.seq AS b FROM docs a JOIN docs b ON b.doc_id = a.doc_id + 1)
SELECT doc_id, CAST(coalesce(list_sum(list_transform(range(1, least(length(a), length(b)) + 1), lambda i: CASE WHEN a[i] = b[i] OR a[i] = 'N' OR b[i] = 'N' THEN 0 ELSE 1 END)), 0) AS INT) AS mismatches FROM p
""")
def hamming_anchor(spark, sf_dir):
    return _neighbours(spark, sf_dir).select("doc_id", fx.hamming(F.col("a"), F.col("b")).alias("mismatches"))


@query(f"""
WITH {_DOCS}, p AS (SELECT doc_id, seq, substr(seq, greatest(length(seq) - 11, 1)) AS pat FROM docs)
SELECT doc_id, CAST(coalesce(list_filter(range(0, length(seq) - length(pat) + 1), lambda i: coalesce(list_sum(list_transform(range(1, length(pat) + 1), lambda j: CASE WHEN seq[i + j] = pat[j] OR seq[i + j] = 'N' OR pat[j] = 'N' THEN 0 ELSE 1 END)), 0) <= 2)[1], -1) AS INT) AS place FROM p
""")
def approx_find(spark, sf_dir):
    docs = _sequences(spark, sf_dir).withColumn("pat", F.substr("seq", F.greatest(F.length("seq") - 11, F.lit(1))))
    return docs.select("doc_id", alignment.first_approximate("seq", "pat", F.lit(2)).alias("place"))


@query("SELECT doc_id, translate(text, '-.', '') AS seq FROM documents")
def ungap(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", fx.ungap(F.col("text")).alias("seq"))


@query(f"WITH {_DOCS}, c AS (SELECT doc_id, length(seq) AS n, doc_id % 50 AS st, length(seq) - doc_id % 7 + 3 AS en FROM docs) SELECT doc_id, st >= 1 AND st < en AND en <= n AND en - st + 1 >= 200 AS valid FROM c")
def valid_cuts(spark, sf_dir):
    n = F.length("seq")
    valid = pipelines.valid_cut(F.col("doc_id") % 50, n - F.col("doc_id") % 7 + 3, n, 200)
    return _sequences(spark, sf_dir).select("doc_id", valid.alias("valid"))


# --- pileups ---------------------------------------------------------------------------------

#: The bucket that each type of event stands for.
EVENT_BUCKETS = {"view": ".", "click": ",", "error": "A", "purchase": "C", "signup": "G"}
_PILEUP = """
o AS (SELECT user_id AS pos, CASE event_type WHEN 'view' THEN '.' WHEN 'click' THEN ',' WHEN 'error' THEN 'A' WHEN 'purchase' THEN 'C' WHEN 'signup' THEN 'G' END AS b FROM events WHERE value >= 13),
n AS (SELECT pos, CASE pos % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'G' WHEN 3 THEN 'T' ELSE 'R' END AS ref, count(*) FILTER (b = '.') AS ref_fwd, count(*) FILTER (b = ',') AS ref_rev, count(*) FILTER (b = 'A') AS a, count(*) FILTER (b = 'C') AS c, count(*) FILTER (b = 'G') AS g, count(*) FILTER (b = 'T') AS t FROM o GROUP BY pos)
"""


def _pileup(spark, sf_dir):
    bucket = F.create_map(*[F.lit(x) for kv in EVENT_BUCKETS.items() for x in kv])
    rows = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("pos"), bucket[F.col("event_type")].alias("bucket"), "value")
    counts = pileup.count_observations(rows, ["pos"], "bucket", "value")
    ref = F.element_at(F.array(*map(F.lit, "ACGTR")), (F.col("pos") % 5 + 1).cast("int"))
    return counts.withColumn("ref", ref).select("pos", "ref", "ref_fwd", "ref_rev", "a", "c", "g", "t")


@query(f"WITH {_PILEUP} SELECT * FROM n")
def pileup_counts(spark, sf_dir):
    return _pileup(spark, sf_dir)


@query(f"WITH {_PILEUP} SELECT * FROM n WHERE a + c + g + t > 0 AND (ref NOT IN ('A', 'C', 'G', 'T') OR (greatest(a, c, g, t) >= 3 AND greatest(a, c, g, t) / (a + c + g + t) >= 0.4))")
def variant_filter(spark, sf_dir):
    return pileup.variants(_pileup(spark, sf_dir), "ref", 3, 0.4)


@query(f"""
WITH {_PILEUP} SELECT pos, CASE WHEN a >= greatest(c, g, t) THEN 'A' WHEN c >= greatest(g, t) THEN 'C' WHEN g >= t THEN 'G' ELSE 'T' END AS base
FROM n WHERE ref_fwd + ref_rev + a + c + g + t > 0 AND (ref_fwd + ref_rev = 0 OR (ref_fwd + ref_rev) / (ref_fwd + ref_rev + a + c + g + t) < 0.4) AND greatest(a, c, g, t) > 0
""")
def majority_base(spark, sf_dir):
    return pileup.mutations(_pileup(spark, sf_dir), 0.4).select("pos", "base")


#: What letters of words stand for in pileups made of them.
_LETTERS, _MARKS = "abcdefghijklmnopqrstuvwxyz", ".,ACGTNacgtn+-^$*RYKMBD12V"
_HITS = {
    "ref_fwd": "c = '.'", "ref_rev": "c = ','", "a": "instr('ARWMDHV', c) > 0", "c": "instr('CYSMBHV', c) > 0", "g": "instr('GRSKBDV', c) > 0", "t": "instr('TYWKBDH', c) > 0",
    "n": "c = 'N'", "ins": "c = '+'", "del": "c = '-'", "start": "c = '^'", "end": "c = '$'", "other": "c = 'other' OR c NOT IN ('.', ',', '+', '-', '^', '$', '*') AND instr('ACGTNRYSWKMBDHV', c) = 0",
}


@query(f"""
WITH RECURSIVE w AS (SELECT DISTINCT translate(unnest(string_split(lower(text), ' ')), '{_LETTERS}', '{_MARKS}') AS bases FROM documents),
s(bases, i, skip, num, digits, dead, hit) AS (
  SELECT bases, 0, 0::BIGINT, -1::BIGINT, false, false, NULL::VARCHAR FROM w
  UNION ALL
  SELECT bases, i + 1,
    CASE WHEN num >= 0 AND digit THEN skip WHEN hidden > 0 THEN hidden - 1 WHEN c = '^' THEN 1 ELSE 0 END,
    CASE WHEN num >= 0 AND digit THEN least(num, 100000000) * 10 + CAST(c AS INT) WHEN hidden = 0 AND c IN ('+', '-') THEN 0 ELSE -1 END,
    num >= 0 AND digit, num >= 0 AND NOT digit AND NOT digits,
    CASE WHEN num >= 0 AND digit THEN NULL WHEN num >= 0 AND NOT digits THEN 'other' WHEN hidden = 0 THEN upper(c) END
  FROM (SELECT *, bases[i + 1] AS c, bases[i + 1] IN ('0', '1', '2', '3', '4', '5', '6', '7', '8', '9') AS digit, CASE WHEN num >= 0 THEN num ELSE skip END AS hidden FROM s WHERE NOT dead AND i < length(bases))
),
h AS (SELECT bases, hit AS c FROM s WHERE hit IS NOT NULL UNION ALL SELECT bases, 'other' FROM s WHERE i = length(bases) AND num >= 0 AND NOT digits AND NOT dead)
SELECT bases, {", ".join(f'count(*) FILTER ({test}) AS "{name}"' for name, test in _HITS.items())} FROM w LEFT JOIN h USING (bases) GROUP BY bases
""")
def pileup_parse(spark, sf_dir):
    words = read_table(spark, sf_dir, "documents").select(F.explode(F.split(F.lower("text"), " ", -1)).alias("word"))
    lines = words.select(F.translate("word", _LETTERS, _MARKS).alias("bases")).distinct()
    return lines.select("bases", pileup.parse_pileup(F.col("bases")).alias("n")).select("bases", "n.*")


@query(f"""
WITH {_PILEUP} SELECT 'c' AS chrom, CAST(pos AS INT) AS pos, ref_fwd, ref_rev, a, c, g, t FROM n
""")
def pileup_table_files(spark, sf_dir):
    folder = scratch_folder(spark)
    none = {n: F.lit(0).cast("long") for n in pileup.BUCKETS if n not in ("ref_fwd", "ref_rev", "a", "c", "g", "t")}
    sources.write_pileup_table(_pileup(spark, sf_dir).withColumns({"chrom": F.lit("c"), **none}), folder)
    return sources.read_pileup_table(spark, folder)


@query(f"""
WITH RECURSIVE d AS (SELECT user_id AS pos, string_agg(CASE event_type WHEN 'view' THEN '.' WHEN 'click' THEN ',' WHEN 'error' THEN 'a' WHEN 'purchase' THEN '^+C' WHEN 'signup' THEN '+2ggR' END, '' ORDER BY event_id) AS bases, count(*) AS depth FROM events GROUP BY user_id)
SELECT 'c' AS chrom, CAST(pos AS INT) AS pos, 'N' AS ref, count(*) FILTER (event_type = 'view') AS ref_fwd, count(*) FILTER (event_type = 'click') AS ref_rev, count(*) FILTER (event_type IN ('error', 'signup')) AS a,
  count(*) FILTER (event_type = 'purchase') AS c, count(*) FILTER (event_type = 'signup') AS g, count(*) FILTER (event_type = 'signup') AS ins, count(*) FILTER (event_type = 'purchase') AS start FROM events JOIN d ON user_id = pos GROUP BY pos
""")
def mpileup_files(spark, sf_dir):
    folder = scratch_folder(spark)
    kinds = {"view": ".", "click": ",", "error": "a", "purchase": "^+C", "signup": "+2ggR"}
    said = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    lines = read_table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("pos")).agg(F.array_sort(F.collect_list(F.struct("event_id", said[F.col("event_type")].alias("b")))).alias("seen"))
    bases = F.array_join(F.transform("seen", lambda x: x["b"]), "")
    lines.select(F.concat_ws("\t", F.lit("c"), "pos", F.lit("N"), F.size("seen").cast("string"), bases, F.lit("II")).alias("value")).write.text(folder)
    return sources.read_mpileup(spark, folder).select("chrom", "pos", "ref", "ref_fwd", "ref_rev", "a", "c", "g", "ins", "start")


@query(f"""
WITH {_PILEUP} SELECT c_custkey AS pos, coalesce(ref_fwd, 0) AS ref_fwd, coalesce(ref_rev, 0) AS ref_rev, coalesce(a, 0) AS a, coalesce(c, 0) AS c, coalesce(g, 0) AS g, coalesce(t, 0) AS t FROM customer LEFT JOIN n ON pos = c_custkey
""")
def pileup_all_positions(spark, sf_dir):
    bucket = F.create_map(*[F.lit(x) for kv in EVENT_BUCKETS.items() for x in kv])
    rows = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("pos"), bucket[F.col("event_type")].alias("bucket"), "value")
    counts = pileup.count_observations(rows, ["pos"], "bucket", "value")
    every = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos"))
    return pileup.with_all_positions(counts, every, ["pos"]).select("pos", "ref_fwd", "ref_rev", "a", "c", "g", "t")


@query(f"""
WITH {_DOCS} SELECT doc_id, array_to_string(list_transform(range(1, length(seq) + 1), lambda i: CASE WHEN i % 14 = 0 THEN 'T' WHEN i % 7 = 0 THEN 'G' ELSE seq[i] END), '') AS seq FROM docs
""")
def apply_mutations(spark, sf_dir):
    docs = _sequences(spark, sf_dir).drop("source")
    places = F.explode(F.filter(F.sequence(F.lit(0), F.length("seq") + 7, F.lit(7)), lambda i: i > 0))
    changes = docs.select("doc_id", places.alias("pos")).withColumn("base", F.when(F.col("pos") % 14 == 0, "T").otherwise("G"))
    return pileup.apply_mutations(docs, changes, "doc_id")


# --- alignments ------------------------------------------------------------------------------

_CELLS = f"{_DOCS}, cells AS (SELECT doc_id, source, unnest(range(length(seq))) AS col, unnest(string_split(seq, '')) AS ch FROM docs WHERE length(seq) > 0)"
_CONSENSUS = f"""{_CELLS}, counts AS (SELECT source, col, count(*) FILTER (ch = 'A') AS a, count(*) FILTER (ch = 'C') AS c, count(*) FILTER (ch = 'G') AS g, count(*) FILTER (ch = 'T') AS t FROM cells GROUP BY source, col),
cons AS (SELECT *, CASE WHEN greatest(a, c, g, t) = 0 THEN 'N' WHEN a >= greatest(c, g, t) THEN 'A' WHEN c >= greatest(g, t) THEN 'C' WHEN g >= t THEN 'G' ELSE 'T' END AS base FROM counts)"""
_FLAGS = f"""{_CONSENSUS}, flags AS (SELECT doc_id, col, (base <> 'N' AND ch <> 'N')::INT AS comp, (base <> 'N' AND ch <> 'N' AND base <> ch)::INT AS mis FROM cells JOIN cons USING (source, col))"""


def _windows(slack: float) -> str:
    return f"""{_FLAGS}, w AS (SELECT doc_id, col, sum(comp) OVER f AS comp, sum(mis) OVER f AS mis, count(*) OVER f AS n, sum(mis) OVER r / sum(comp) OVER r AS overall FROM flags
  WINDOW f AS (PARTITION BY doc_id ORDER BY col ROWS BETWEEN CURRENT ROW AND 399 FOLLOWING), r AS (PARTITION BY doc_id)),
bad AS (SELECT doc_id, col AS s, col + 399 AS e FROM w WHERE n = 400 AND col % 100 = 0 AND comp >= 200 AND mis / comp >= greatest(0.35, least(0.6, overall + {slack}))),
m AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 100 OR row_number() OVER (PARTITION BY doc_id ORDER BY s, e) = 1 THEN 1 ELSE 0 END AS new FROM bad),
i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s, e) AS k FROM m),
merged AS (SELECT doc_id, min(s) AS s, max(e) AS e FROM i GROUP BY doc_id, k)"""


def _rows_and_consensus(spark, sf_dir):
    docs = _sequences(spark, sf_dir)
    return msa.with_consensus(docs, msa.consensus_texts(docs, ["source"], "seq"), ["source"], "seq")


@query(f"WITH {_CONSENSUS} SELECT source, CAST(col AS INT) AS col, a, c, g, t, base FROM cons")
def consensus(spark, sf_dir):
    return msa.consensus(_sequences(spark, sf_dir), ["source"], "seq")


@query(f"""
WITH {_CONSENSUS} SELECT doc_id, count(*) FILTER (base <> 'N' AND ch <> 'N') AS compared, count(*) FILTER (base <> 'N' AND ch <> 'N' AND base = ch) AS equal,
  CASE WHEN count(*) FILTER (base <> 'N' AND ch <> 'N') > 0 AND count(*) FILTER (base <> 'N' AND ch <> 'N' AND base = ch) / count(*) FILTER (base <> 'N' AND ch <> 'N') >= 0.4 THEN 'accepted' ELSE 'rejected' END AS status
FROM cells JOIN cons USING (source, col) GROUP BY doc_id
""")
def identity_gate(spark, sf_dir):
    scores = msa.identity(_rows_and_consensus(spark, sf_dir).filter("seq <> ''"), ["doc_id"], "seq")
    return msa.route_by_identity(scores, 0.4).drop("identity")


@query("""
WITH c AS (SELECT doc_id, unnest(range(length(text))) AS col, upper(unnest(string_split(translate(text, ' ', '-'), ''))) AS ch FROM documents WHERE length(text) > 0),
p AS (SELECT doc_id, col, ch IN ('A', 'C', 'G', 'T', 'N') AS nt, sum((ch IN ('A', 'C', 'G', 'T', 'N'))::INT) OVER (PARTITION BY doc_id ORDER BY col) AS k FROM c)
SELECT doc_id, CAST(max(k) AS INT) AS letters, CAST(sum(CASE WHEN nt THEN k * col ELSE 0 END) AS BIGINT) AS weight, min(col) FILTER (nt) AS first_col FROM p GROUP BY doc_id
""")
def col_to_pos(spark, sf_dir):
    rows = read_table(spark, sf_dir, "documents").filter(F.length("text") > 0).select("doc_id", F.translate("text", " ", "-").alias("seq"))
    placed = msa.with_positions(rows, ["doc_id"], "seq").select("doc_id", F.posexplode("pos").alias("col", "pos"))
    real = F.col("pos") > 0
    return placed.groupBy("doc_id").agg(
        F.greatest(F.max("pos"), F.lit(0)).alias("letters"), F.sum(F.when(real, F.col("pos").cast("long") * F.col("col")).otherwise(0)).alias("weight"), F.min(F.when(real, F.col("col").cast("long"))).alias("first_col")
    )


@query(f"WITH {_windows(0.02)} SELECT doc_id, s, e FROM bad")
def mismatch_windows(spark, sf_dir):
    return msa.mismatch_windows(_rows_and_consensus(spark, sf_dir), ["doc_id"], "seq", slack=0.02).select("doc_id", F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"))


@query(f"WITH {_windows(0.02)} SELECT * FROM merged")
def merge_windows(spark, sf_dir):
    bad = msa.mismatch_windows(_rows_and_consensus(spark, sf_dir), ["doc_id"], "seq", slack=0.02)
    return msa.merge_intervals(bad, ["doc_id"], 100).select("doc_id", F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"))


@query("""
WITH s AS (SELECT user_id, event_id AS o, CASE WHEN event_type IN ('error', 'purchase') THEN 1 WHEN event_type = 'view' THEN 0 ELSE -1 END AS v FROM events),
p AS (SELECT user_id, o, row_number() OVER w AS i, sum(v) OVER w AS p FROM s WINDOW w AS (PARTITION BY user_id ORDER BY o)),
z AS (SELECT user_id, o, i, p FROM p UNION ALL SELECT DISTINCT user_id, NULL, 0, 0 FROM p),
g AS (SELECT b.user_id, b.o AS e, b.i, a.i AS j, b.p - a.p AS gain, row_number() OVER (PARTITION BY b.user_id ORDER BY b.p - a.p DESC, b.i, a.i DESC) AS n FROM z b JOIN z a ON a.user_id = b.user_id AND a.i < b.i)
SELECT g.user_id, p.o AS s, g.e, CAST(g.gain AS BIGINT) AS total FROM g JOIN p ON p.user_id = g.user_id AND p.i = g.j + 1 WHERE n = 1 AND gain > 0
""")
def max_excess_block(spark, sf_dir):
    score = F.when(F.col("event_type").isin("error", "purchase"), 1).when(F.col("event_type") == "view", 0).otherwise(-1)
    return msa.max_excess_block(read_table(spark, sf_dir, "events").select("user_id", "event_id", score.alias("score")), ["user_id"], "event_id")


@query(f"""
WITH {_windows(0.25)},
sized AS (SELECT doc_id, s, e, sum(comp) AS comp FROM merged JOIN flags USING (doc_id) WHERE col BETWEEN s AND e GROUP BY ALL HAVING sum(comp) >= 300),
blocks AS (SELECT *, 'windows' AS found_by FROM sized QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY comp DESC, s) = 1),
p AS (SELECT doc_id, col, sum(CASE WHEN comp = 0 THEN 0 WHEN mis = 1 THEN 1 ELSE -1 END) OVER (PARTITION BY doc_id ORDER BY col) AS p FROM flags),
low AS (SELECT doc_id, col, p, least(coalesce(min(p * 10000000 - (col + 1)) OVER (PARTITION BY doc_id ORDER BY col ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS x FROM p),
gains AS (SELECT doc_id, col AS e, p - CAST(ceil(x / 10000000) AS BIGINT) AS gain, CAST(ceil(x / 10000000) AS BIGINT) * 10000000 - x AS s FROM low),
best AS (SELECT * FROM gains WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY gain DESC, e) = 1),
excess AS (SELECT doc_id, s, e, sum(comp) AS comp FROM best JOIN flags USING (doc_id) WHERE col BETWEEN s AND e AND doc_id NOT IN (SELECT doc_id FROM blocks) GROUP BY ALL HAVING sum(comp) >= 300)
SELECT doc_id, CAST(s AS INT) AS s, CAST(e AS INT) AS e, CAST(comp AS BIGINT) AS comp, found_by FROM blocks UNION ALL SELECT doc_id, CAST(s AS INT), CAST(e AS INT), CAST(comp AS BIGINT), 'excess' FROM excess
""")
def inversion_block(spark, sf_dir):
    return msa.inversion_block(_rows_and_consensus(spark, sf_dir), ["doc_id"], 400, 300, 300, "seq")


# --- k-mers and anchors ----------------------------------------------------------------------

_KMERS = f"{_DOCS}, k AS (SELECT DISTINCT doc_id, substr(seq, i, 9) AS kmer FROM docs, unnest(range(1, length(seq) - 7)) AS u(i) WHERE length(seq) >= 9), kk AS (SELECT * FROM k WHERE kmer NOT LIKE '%N%')"
_SEEDS = f"""{_DOCS}, ki AS (SELECT doc_id, i - 1 AS i, substr(seq, i, 9) AS kmer FROM docs, unnest(range(1, length(seq) - 7)) AS u(i) WHERE length(seq) >= 9),
seeds AS (SELECT a.doc_id, a.i, b.i AS j FROM ki a JOIN ki b ON b.doc_id = a.doc_id + 1 AND a.kmer = b.kmer WHERE a.kmer NOT LIKE '%N%')"""


@query(f"""
WITH {_KMERS}, p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM docs a JOIN docs b ON b.doc_id = a.doc_id + 1), n AS (SELECT doc_id, count(*) AS n FROM kk GROUP BY doc_id),
s AS (SELECT x.doc_id AS a, count(*) AS shared FROM kk x JOIN kk y ON y.doc_id = x.doc_id + 1 AND x.kmer = y.kmer GROUP BY x.doc_id)
SELECT p.a, p.b, coalesce(shared, 0) AS shared, coalesce(na.n, 0) + coalesce(nb.n, 0) - coalesce(shared, 0) AS total FROM p LEFT JOIN s USING (a) LEFT JOIN n na ON na.doc_id = p.a LEFT JOIN n nb ON nb.doc_id = p.b
""")
def kmer_jaccard(spark, sf_dir):
    docs = _sequences(spark, sf_dir)
    pairs = docs.select(F.col("doc_id").alias("a")).join(docs.select(F.col("doc_id").alias("b")), F.col("b") == F.col("a") + 1)
    return kmers.kmer_jaccard(docs, pairs, "doc_id", "seq", 9).drop("jaccard")


@query(f"""
WITH {_SEEDS}, d AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, i - j ORDER BY i) AS k FROM seeds),
m AS (SELECT doc_id, min(i) AS a0, min(j) AS b0, count(*) + 8 AS size FROM d GROUP BY doc_id, i - j, k)
SELECT doc_id, a0, b0, size FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY size DESC, b0 + size DESC, a0) AS n FROM m) WHERE n = 1
""")
def mem_anchors(spark, sf_dir):
    found = kmers.exact_matches(_neighbours(spark, sf_dir), ["doc_id"], "a", "b", 9)
    best = kmers.best_border_match(found, ["doc_id"], "left")
    return best.select("doc_id", F.col("a0").cast("long").alias("a0"), F.col("b0").cast("long").alias("b0"), "size")


@query(f"WITH {_SEEDS}, p AS (SELECT a.doc_id FROM docs a JOIN docs b ON b.doc_id = a.doc_id + 1) SELECT p.doc_id, max(j) AS \"left\", min(j) AS \"right\" FROM p LEFT JOIN seeds USING (doc_id) GROUP BY p.doc_id")
def nearest_anchor(spark, sf_dir):
    found = kmers.nearest_anchors(_neighbours(spark, sf_dir), ["doc_id"], "a", "b", 9)
    return found.select("doc_id", F.col("left").cast("long").alias("left"), F.col("right").cast("long").alias("right"))


_SET = "list_distinct(list_filter(list_transform(range(1, length({0}) - 7), lambda i: substr({0}, i, 9)), lambda x: NOT contains(x, 'N')))"


@query(f"""
WITH {_DOCS}, p AS (SELECT a.doc_id, a.seq AS a, b.seq AS b, length(b.seq) // 4 + 1 AS st, length(b.seq) // 2 AS en FROM docs a JOIN docs b ON b.doc_id = a.doc_id + 1 WHERE length(b.seq) >= 4),
c AS (SELECT doc_id, a, false AS flipped, b AS seq FROM p UNION ALL SELECT doc_id, a, true, substr(b, 1, st - 1) || {_COMPLEMENT.format("substr(b, st, en - st + 1)")} || substr(b, en + 1) FROM p),
k AS (SELECT doc_id, flipped, {_SET.format("a")} AS x, {_SET.format("seq")} AS y FROM c),
n AS (SELECT doc_id, flipped, len(list_intersect(x, y)) AS shared, len(x) + len(y) AS n FROM k)
SELECT doc_id, flipped, CAST(shared AS BIGINT) AS shared, CAST(n - shared AS BIGINT) AS total,
  row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN n > shared THEN shared / (n - shared) ELSE 0 END DESC, flipped DESC) = 1 AS chosen FROM n
""")
def choose_variant(spark, sf_dir):
    pairs = _neighbours(spark, sf_dir).filter("length(b) >= 4")
    turned = fx.flip_segment(F.col("b"), F.expr("int(length(b) div 4) + 1"), F.expr("int(length(b) div 2)"))
    both = F.explode(F.array(F.struct(F.lit(False).alias("flipped"), F.col("b").alias("seq")), F.struct(F.lit(True).alias("flipped"), turned.alias("seq"))))
    rows = pairs.select("doc_id", "a", both.alias("x")).select("doc_id", "x.flipped", kmers.shared_kmers(9)("a", "x.seq").alias("n"))
    rows = rows.select("doc_id", "flipped", "n.*").withColumn("score", F.when(F.col("total") > 0, F.col("shared") / F.col("total")).otherwise(0.0))
    return msa.choose_orientation(rows, ["doc_id"], "score", "flipped").drop("score")


@query(f"""
WITH RECURSIVE p AS (SELECT p_partkey, upper(p_name) AS a, upper(p_type) AS b FROM part),
t(p_partkey, a, b, i, h) AS (
  SELECT p_partkey, a, b, 0, [list_transform(range(0, length(b) + 1), lambda j: 0)] FROM p
  UNION ALL
  SELECT p_partkey, a, b, i + 1, list_append(h, list_transform(range(1, len(r) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: r[k] - 2 * (j - k)))))
  FROM (SELECT *, list_transform(range(0, length(b) + 1), lambda j: CASE WHEN j = 0 THEN 0 ELSE greatest(0, h[i + 1][j] + CASE WHEN a[i + 1] = b[j] THEN 2 ELSE -1 END, h[i + 1][j + 1] - 2) END) AS r FROM t WHERE i < length(a))
),
f AS (SELECT p_partkey, a, b, h, list_max(flatten(h)) AS score, list_position(flatten(h), list_max(flatten(h))) - 1 AS cell FROM t WHERE i = length(a)),
w(p_partkey, a, b, h, score, ei, ej, i, j, si, sj) AS (
  SELECT p_partkey, a, b, h, score, cell // (length(b) + 1), cell % (length(b) + 1), cell // (length(b) + 1), cell % (length(b) + 1), 0::BIGINT, 0::BIGINT FROM f WHERE score > 0
  UNION ALL
  SELECT p_partkey, a, b, h, score, ei, ej, CASE WHEN diagonal OR up THEN i - 1 ELSE i END, CASE WHEN diagonal OR NOT up THEN j - 1 ELSE j END, i, j
  FROM (SELECT *, h[i + 1][j + 1] = h[i][j] + CASE WHEN a[i] = b[j] THEN 2 ELSE -1 END AS diagonal, h[i + 1][j + 1] = h[i][j + 1] - 2 AS up FROM w WHERE h[i + 1][j + 1] > 0)
)
SELECT p_partkey, CAST(si AS INT) AS a_st, CAST(ei AS INT) AS a_en, CAST(sj AS INT) AS b_st, CAST(ej AS INT) AS b_en, CAST(score AS INT) AS score FROM w WHERE h[i + 1][j + 1] = 0
UNION ALL SELECT p_partkey, NULL, NULL, NULL, NULL, NULL FROM f WHERE score <= 0
""")
def smith_waterman(spark, sf_dir):
    found = read_table(spark, sf_dir, "part").select("p_partkey", alignment.smith_waterman("p_name", "p_type").alias("x"))
    return found.select("p_partkey", "x.*")


@query("""
WITH RECURSIVE p AS (SELECT p_partkey, p_name AS a, p_type AS b FROM part),
t(p_partkey, a, b, i, h) AS (
  SELECT p_partkey, a, b, 0, list_transform(range(0, length(b) + 1), lambda j: -2 * j) FROM p
  UNION ALL
  SELECT p_partkey, a, b, i + 1, list_transform(range(1, len(r) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: r[k] - 2 * (j - k))))
  FROM (SELECT *, list_transform(range(0, length(b) + 1), lambda j: CASE WHEN j = 0 THEN -2 * (i + 1) ELSE greatest(h[j] + CASE WHEN a[i + 1] = b[j] THEN 1 ELSE -1 END, h[j + 1] - 2) END) AS r FROM t WHERE i < length(a))
)
SELECT p_partkey, a, b, CAST(h[length(b) + 1] AS INT) AS score FROM t WHERE i = length(a)
""")
def pair_alignment(spark, sf_dir):
    found = read_table(spark, sf_dir, "part").select("p_partkey", alignment.align_pair("p_name", "p_type").alias("x"))
    value = F.zip_with(F.split("x.a", ""), F.split("x.b", ""), lambda p, q: F.when((p == "-") | (q == "-"), -2).when(p == q, 1).otherwise(-1))
    return found.select("p_partkey", F.replace("x.a", F.lit("-"), F.lit("")).alias("a"), F.replace("x.b", F.lit("-"), F.lit("")).alias("b"), F.aggregate(value, F.lit(0), lambda s, x: s + x).alias("score"))


@query("""
SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_suppkey, l_partkey, l_orderkey, l_linenumber) - 1 AS nth FROM lineitem
""")
def coordinate_sort(spark, sf_dir):
    rows = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber")
    return kmers.coordinate_order(rows, ["l_suppkey", "l_partkey", "l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "nth")


@query()
def circular_rotation(spark, sf_dir):
    return alignment.rotate_to_anchor(_neighbours(spark, sf_dir), ["doc_id"], "a", "b", anchor=16, most=3, k=9)


#: Items lie on few documents, so one read is enough evidence here.
ONE_READ = pipelines.Settings(least_alt=1, mapper="votes")

#: Every letter stands for a base in the sequences that reads are mapped to.
_ALPHABET, _AS_BASES = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 2 * "ACGTACGTACGTACGTACGTACGTAC"
_BASES = f"regexp_replace(translate(text, '{_ALPHABET}', '{_AS_BASES}'), '[^ACGT]', '', 'g')"
_MAPPED = f"""docs AS (SELECT doc_id, {_BASES} AS seq FROM documents), r AS (SELECT item_id, {_BASES} AS seq FROM benchmark),
rs AS (SELECT item_id, '+' AS strand, seq AS s FROM r UNION ALL SELECT item_id, '-', {_COMPLEMENT.format("seq")} FROM r),
rk AS (SELECT * FROM (SELECT item_id, strand, i - 1 AS i, substr(s, i, 15) AS kmer FROM rs, unnest(range(1, length(s) - 13)) AS u(i) WHERE length(s) >= 15) WHERE NOT contains(kmer, 'N')),
ck AS (SELECT CAST(doc_id AS VARCHAR) AS chrom, i - 1 AS place, substr(seq, i, 15) AS kmer FROM docs, unnest(range(1, length(seq) - 13)) AS u(i) WHERE length(seq) >= 15),
votes AS (SELECT item_id, chrom, strand, place - i + 1 AS pos, count(*) AS seeds FROM rk JOIN ck USING (kmer) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY seeds DESC, chrom, pos, strand) AS n FROM votes),
sizes AS (SELECT item_id, max(c) AS most FROM (SELECT item_id, strand, count(*) AS c FROM rk GROUP BY ALL) GROUP BY item_id),
mapped AS (SELECT x.item_id, x.chrom, CAST(x.pos AS INT) AS pos, x.strand, x.seeds, CAST(floor(60 * (1 - coalesce(y.seeds, 0) / x.seeds)) AS INT) AS mapq
  FROM (SELECT * FROM ranked WHERE n = 1) x LEFT JOIN (SELECT * FROM ranked WHERE n = 2) y USING (item_id) JOIN sizes USING (item_id) WHERE x.seeds >= least(2, most))"""
_VARIANTS = f"""{_MAPPED}, bases AS (SELECT chrom, strand, pos + j AS pos, s[j + 1] AS b FROM mapped JOIN rs USING (item_id, strand), unnest(range(0, length(s))) AS u(j)),
seen AS (SELECT chrom, strand, pos, b, substr(seq, pos, 1) AS ref FROM bases JOIN docs ON chrom = CAST(doc_id AS VARCHAR) WHERE pos BETWEEN 1 AND length(seq)),
n AS (SELECT chrom, pos, ref, count(*) FILTER (b = ref AND strand = '+') AS ref_fwd, count(*) FILTER (b = ref AND strand = '-') AS ref_rev, count(*) FILTER (b <> ref AND b = 'A') AS a, count(*) FILTER (b <> ref AND b = 'C') AS c,
  count(*) FILTER (b <> ref AND b = 'G') AS g, count(*) FILTER (b <> ref AND b = 'T') AS t, count(*) FILTER (b <> ref AND b = 'N') AS n, 0::BIGINT AS ins, 0::BIGINT AS "del", 0::BIGINT AS start, 0::BIGINT AS "end", 0::BIGINT AS other FROM seen GROUP BY ALL),
found AS (SELECT * FROM n WHERE a + c + g + t > 0 AND (ref = 'N' OR greatest(a, c, g, t) / (a + c + g + t) >= 0.6))"""


def _as_bases():
    return F.regexp_replace(F.translate("text", _ALPHABET, _AS_BASES), "[^ACGT]+", "")


def _reads(spark, sf_dir):
    """Benchmark items as reads; some documents hold passages of them."""
    rows = read_table(spark, sf_dir, "benchmark").select("item_id", _as_bases().alias("seq"))
    return rows.withColumn("qual", F.repeat(F.lit("I"), F.length("seq")))


def _contigs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("chrom"), _as_bases().alias("seq"))


@query(f"WITH {_MAPPED} SELECT * FROM mapped")
def read_mapping(spark, sf_dir):
    return kmers.map_reads(_reads(spark, sf_dir).drop("qual"), _contigs(spark, sf_dir), ["item_id"])


@query(f"WITH {_VARIANTS} SELECT * REPLACE (CAST(pos AS INT) AS pos) FROM found")
def variant_table(spark, sf_dir):
    return pipelines.variant_table(_reads(spark, sf_dir), _contigs(spark, sf_dir), ["item_id"], ONE_READ)


@query(f"""
WITH {_VARIANTS}, changes AS (SELECT chrom, pos, CASE WHEN a >= greatest(c, g, t) THEN 'A' WHEN c >= greatest(g, t) THEN 'C' WHEN g >= t THEN 'G' ELSE 'T' END AS base
  FROM found WHERE ref_fwd + ref_rev = 0 OR (ref_fwd + ref_rev) / (ref_fwd + ref_rev + a + c + g + t) < 0.5),
letters AS (SELECT CAST(doc_id AS VARCHAR) AS chrom, unnest(range(1, length(seq) + 1)) AS pos, unnest(string_split(seq, '')) AS ch FROM docs WHERE length(seq) > 0),
fixed AS (SELECT chrom, string_agg(coalesce(base, ch), '' ORDER BY pos) AS seq FROM letters LEFT JOIN changes USING (chrom, pos) GROUP BY chrom)
SELECT CAST(doc_id AS VARCHAR) AS chrom, coalesce(fixed.seq, '') AS seq, '>' || doc_id || ', Hordeum vulgare, ' || length(coalesce(fixed.seq, '')) AS header FROM docs LEFT JOIN fixed ON chrom = CAST(doc_id AS VARCHAR)
""")
def correct_sequences(spark, sf_dir):
    contigs = _contigs(spark, sf_dir)
    return pipelines.correct_sequences(contigs, pipelines.variant_table(_reads(spark, sf_dir), contigs, ["item_id"], ONE_READ))


def _jaccard(name: str, a: str, b: str, source: str, k: int) -> str:
    """SQL of the share of different k-mers of two columns that both have, as ``{name}(doc_id, score)``."""
    side = lambda c: f"SELECT DISTINCT doc_id, substr({c}, i, {k}) AS w FROM {source}, unnest(range(1, length({c}) - {k - 2})) AS u(i) WHERE length({c}) >= {k}"
    return f"""{name} AS (SELECT doc_id, count(*) FILTER (n = 2) / count(*) AS score FROM (SELECT doc_id, w, count(*) AS n FROM ({side(a)} UNION ALL {side(b)}) GROUP BY ALL) GROUP BY doc_id)"""


_TURNED = f"""docs AS (SELECT doc_id, {_BASES} AS c FROM documents),
pairs AS (SELECT doc_id, c, CASE WHEN length(c) >= 4 THEN substr(c, 1, length(c) // 4) || {_COMPLEMENT.format("substr(c, length(c) // 4 + 1, length(c) // 2 - length(c) // 4)")} || substr(c, length(c) // 2 + 1) ELSE c END AS q FROM docs),
flags AS (SELECT doc_id, unnest(range(length(c))) AS col, (unnest(string_split(c, '')) <> unnest(string_split(q, '')))::INT AS mis FROM pairs WHERE length(c) > 0),
w AS (SELECT doc_id, col, sum(mis) OVER f AS mis, count(*) OVER f AS n, sum(mis) OVER r / count(*) OVER r AS overall FROM flags WINDOW f AS (PARTITION BY doc_id ORDER BY col ROWS BETWEEN CURRENT ROW AND 99 FOLLOWING), r AS (PARTITION BY doc_id)),
bad AS (SELECT doc_id, col AS s, col + 99 AS e FROM w WHERE n = 100 AND col % 100 = 0 AND mis / 100 >= greatest(0.35, least(0.6, overall + 0.25))),
m AS (SELECT *, coalesce((s > max(e) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 100)::INT, 1) AS new FROM bad),
merged AS (SELECT doc_id, min(s) AS s, max(e) AS e FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM m) GROUP BY doc_id, k),
wide AS (SELECT * FROM merged WHERE e - s + 1 >= 300 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY e - s DESC, s) = 1),
p AS (SELECT doc_id, col, sum(2 * mis - 1) OVER (PARTITION BY doc_id ORDER BY col) AS p FROM flags),
low AS (SELECT doc_id, col, p, least(coalesce(min(p * 10000000 - (col + 1)) OVER (PARTITION BY doc_id ORDER BY col ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS x FROM p),
gains AS (SELECT doc_id, col AS e, p - CAST(ceil(x / 10000000) AS BIGINT) AS gain, CAST(ceil(x / 10000000) AS BIGINT) * 10000000 - x AS s FROM low),
excess AS (SELECT doc_id, s, e FROM gains WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY gain DESC, e) = 1),
blocks AS (SELECT * FROM wide UNION ALL SELECT * FROM excess WHERE e - s + 1 >= 300 AND doc_id NOT IN (SELECT doc_id FROM wide)),
found AS (SELECT doc_id, c, q, s + 1 AS q_st, e + 1 AS q_en, CAST(greatest(1, s - 99) AS BIGINT) AS a, CAST(least(length(q), e + 101) AS BIGINT) AS z FROM blocks JOIN pairs USING (doc_id)),
ck AS (SELECT doc_id, substr(c, i, 15) AS w, min(i) AS i FROM found, unnest(range(1, length(c) - 13)) AS u(i) GROUP BY ALL HAVING count(*) = 1),
qk AS (SELECT doc_id, {_COMPLEMENT.format("substr(q, j, 15)")} AS w, min(j) AS j FROM found, unnest(range(a, z - 13)) AS u(j) GROUP BY ALL HAVING count(*) = 1),
votes AS (SELECT doc_id, i + j + 14 AS total, count(*) AS n FROM ck JOIN qk USING (doc_id, w) GROUP BY ALL),
totals AS (SELECT doc_id, total FROM votes QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, total) = 1),
letters AS (SELECT doc_id, total, unnest(range(1, length(c) + 1)) AS i, unnest(string_split(c, '')) AS cc, unnest(string_split(q, '')) AS qc FROM found JOIN totals USING (doc_id)),
steps AS (SELECT a.doc_id, a.i, coalesce(({_COMPLEMENT.format("a.qc")} = b.cc)::INT, 0) - (a.qc = a.cc)::INT AS v FROM letters a LEFT JOIN letters b ON b.doc_id = a.doc_id AND b.i = a.total - a.i),
sums AS (SELECT doc_id, i, sum(v) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM steps),
least_ AS (SELECT doc_id, i, p, least(coalesce(min(p * 10000000 - i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS x FROM sums),
ends AS (SELECT doc_id, CAST(ceil(x / 10000000) AS BIGINT) * 10000000 - x + 1 AS first, i AS last FROM least_ WHERE p > CAST(ceil(x / 10000000) AS BIGINT) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY p - CAST(ceil(x / 10000000) AS BIGINT) DESC, i) = 1),
cuts AS (SELECT doc_id, c, q, CAST(coalesce(first, q_st) AS INT) AS first, CAST(coalesce(last, q_en) AS INT) AS last, CASE WHEN first IS NULL THEN 'block' ELSE 'breakpoints' END AS "by" FROM found LEFT JOIN ends USING (doc_id)),
turned AS (SELECT *, substr(q, 1, first - 1) || {_COMPLEMENT.format("substr(q, first, last - first + 1)")} || substr(q, last + 1) AS t FROM cuts),
{_jaccard("was", "c", "q", "turned", 21)}, {_jaccard("is_", "c", "t", "turned", 21)}"""


@query(f"""
WITH {_TURNED}
SELECT p.doc_id, CASE WHEN is_.score >= was.score THEN t ELSE p.q END AS seq, first, last, "by", coalesce(is_.score >= was.score, false) AS flipped, was.score AS before, is_.score AS after
FROM pairs p LEFT JOIN turned USING (doc_id) LEFT JOIN was USING (doc_id) LEFT JOIN is_ USING (doc_id)
""")
def genome_inversion(spark, sf_dir):
    """Every document's bases, and the same with their second quarter turned round, which is found and turned back."""
    rows = read_table(spark, sf_dir, "documents").select("doc_id", _as_bases().alias("cons"))
    turned = fx.flip_segment(F.col("cons"), F.expr("int(length(cons) div 4) + 1"), F.expr("int(length(cons) div 2)"))
    planted = rows.withColumn("new", F.when(F.length("cons") >= 4, turned).otherwise(F.col("cons")))
    return pipelines.repair_inversions(planted, "doc_id", pipelines.Settings(window=100, least_block=300, least_excess=300))


@query("""
WITH t AS (SELECT CAST(conv_id AS VARCHAR) AS sample, turn, coalesce(text, '') AS x FROM conversations),
h AS (SELECT sample, turn, substr(x, 1, length(x) // 2) AS a, substr(x, length(x) // 2 + 1) AS b FROM t),
once AS (SELECT sample, a, b, min(turn) AS read_idx, count(*) AS copies FROM h GROUP BY sample, a, b),
cut AS (SELECT *, trim(CASE WHEN contains(a, 'please') THEN substr(a, 1, instr(a, 'please') - 1) ELSE a END, ' ') AS seq1, trim(CASE WHEN contains(b, 'please') THEN substr(b, 1, instr(b, 'please') - 1) ELSE b END, ' ') AS seq2 FROM once)
SELECT sample, seq1, seq2, read_idx, regexp_replace(regexp_replace(seq1, '[^ ]', 'I', 'g'), ' ', '#', 'g') AS qual1, regexp_replace(regexp_replace(seq2, '[^ ]', 'I', 'g'), ' ', '#', 'g') AS qual2, copies,
  CASE WHEN seq1 <> '' AND seq2 <> '' THEN 'paired' WHEN seq1 <> '' THEN 'unpaired_1' WHEN seq2 <> '' THEN 'unpaired_2' ELSE 'dropped' END AS route FROM cut
""")
def assembly_reads(spark, sf_dir):
    """Turns of a conversation as mates: first and second halves of turns are a pair, both cut at an adapter and at low qualities."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    half = F.expr("int(length(text) div 2)")
    sides = F.array(F.struct(F.lit(1).alias("mate"), F.substr("text", F.lit(1), half).alias("seq")), F.struct(F.lit(2).alias("mate"), F.substr("text", half + 1).alias("seq")))
    mates = turns.select(F.col("conv_id").cast("string").alias("sample"), F.col("turn").alias("read_idx"), F.explode(sides).alias("x")).select("sample", "read_idx", "x.*")
    mates = mates.withColumn("qual", F.regexp_replace(F.regexp_replace("seq", "[^ ]", "I"), " ", "#"))
    return pipelines.reads_for_assembly(mates, "please")


# --- gapped mapping --------------------------------------------------------------------------

#: A contig without repeats for each document, from hashes of its id and of numbers up to a 64th of its text's length, and reads from it: at every
#: 400th base 120 bases as they are, without three of them, with three more, or turned round with one changed.
_HEX, _HEX_BASES = "0123456789abcdef", "ACGTACGTACGTACGT"
_PLANTED = f"""chroms AS (SELECT CAST(doc_id AS VARCHAR) AS chrom, translate(string_agg(md5(doc_id || ':' || i), '' ORDER BY i), '{_HEX}', '{_HEX_BASES}') AS seq FROM documents, unnest(range(0, 16 + length(text) // 64)) AS t(i) GROUP BY doc_id),
spots AS (SELECT chrom, seq, i AS spot, i // 400 % 4 AS form, substr(seq, i + 1, 120) AS s FROM chroms, unnest(range(0, length(seq) - 119, 400)) AS t(i)),
planted AS (SELECT chrom, chrom || ':' || spot AS read, spot, form, CASE form WHEN 0 THEN s WHEN 1 THEN substr(s, 1, 60) || substr(s, 64) WHEN 2 THEN substr(s, 1, 60) || translate(substr(s, 59, 3), 'ACGT', 'CGTA') || substr(s, 61) ELSE substr(s, 1, 60) || translate(substr(s, 61, 1), 'ACGT', 'CGTA') || substr(s, 62) END AS s FROM spots)"""


def _planted(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
    pieces = F.transform(F.sequence(F.lit(0), F.expr("15 + int(n div 64)")), lambda i: F.md5(F.concat_ws(":", "doc_id", i)))
    chroms = docs.select(F.col("doc_id").cast("string").alias("chrom"), F.translate(F.array_join(pieces, ""), _HEX, _HEX_BASES).alias("seq"))
    spots = chroms.select("chrom", "seq", F.explode(F.sequence(F.lit(0), F.length("seq") - 120, F.lit(400))).alias("spot"))
    spots = spots.select(F.concat_ws(":", "chrom", "spot").alias("read"), (F.floor(F.col("spot") / 400) % 4).alias("form"), F.substr("seq", F.col("spot") + 1, F.lit(120)).alias("s"))
    part = lambda a, n=120: F.substr("s", F.lit(a), F.lit(n))
    other = lambda a, n: F.translate(part(a, n), "ACGT", "CGTA")
    changed = fx.revcomp(F.concat(part(1, 60), other(61, 1), part(62)))
    seq = F.when(F.col("form") == 0, F.col("s")).when(F.col("form") == 1, F.concat(part(1, 60), part(64))).when(F.col("form") == 2, F.concat(part(1, 60), other(59, 3), part(61))).otherwise(changed)
    return spots.select("read", seq.alias("seq"), F.repeat(F.lit("I"), F.length(seq)).alias("qual")), chroms


@query(f"""
WITH {_PLANTED} SELECT read, chrom, CAST(spot + 1 AS INT) AS pos, CASE form WHEN 3 THEN '-' ELSE '+' END AS strand, CASE form WHEN 0 THEN 240 WHEN 1 THEN 224 WHEN 2 THEN 230 ELSE 234 END AS score,
  CASE form WHEN 2 THEN 3 ELSE 0 END AS inserted, CASE form WHEN 1 THEN 3 ELSE 0 END AS deleted, CASE form WHEN 3 THEN 1 ELSE 0 END AS changed FROM planted
""")
def gapped_mapping(spark, sf_dir):
    """Reads with planted insertions, deletions and changes come back to their places, with what was planted in their CIGARs."""
    reads, chroms = _planted(spark, sf_dir)
    mapped = mapping.map_gapped(reads, chroms, ["read"])
    total = lambda step: F.aggregate(F.regexp_extract_all("cigar", F.lit(f"([0-9]+){step}"), F.lit(1)), F.lit(0), lambda n, x: n + x.cast("int"))
    return mapped.select("read", "chrom", "pos", "strand", "score", total("I").alias("inserted"), total("D").alias("deleted"), total("X").alias("changed"))


@query(f"""
WITH {_PLANTED} SELECT chrom, sum(CASE form WHEN 1 THEN 117 WHEN 3 THEN 0 ELSE 120 END)::BIGINT AS ref_fwd, sum(CASE form WHEN 3 THEN 119 ELSE 0 END)::BIGINT AS ref_rev,
  count(*) FILTER (form = 3 AND s[61] = 'A') AS a, count(*) FILTER (form = 3 AND s[61] = 'C') AS c, count(*) FILTER (form = 3 AND s[61] = 'G') AS g, count(*) FILTER (form = 3 AND s[61] = 'T') AS t,
  count(*) FILTER (form = 2) AS ins, count(*) FILTER (form = 1) AS "del", count(*) AS start, count(*) AS "end", count(DISTINCT spot) FILTER (form = 3) AS found FROM planted GROUP BY chrom
""")
def indel_pileup(spark, sf_dir):
    """Pileups of the reads by CIGAR, summed by contig, and the positions at which a base is found to differ."""
    reads, chroms = _planted(spark, sf_dir)
    counts = pipelines.pileup_of(mapping.map_gapped(reads, chroms, ["read"]), reads, chroms, ["read"])
    names = ["ref_fwd", "ref_rev", "a", "c", "g", "t", "ins", "del", "start", "end"]
    differs = pileup.variants(counts, least_count=1).groupBy("chrom").agg(F.count("*").alias("found"))
    sums = counts.groupBy("chrom").agg(*[F.sum(n).alias(n) for n in names])
    return sums.join(differs, "chrom", "left").fillna(0, ["found"])


#: The same contigs with their first 400 bases again and an end of their own; pairs of 100 bases of pieces of 300, the last of which lies
#: with one mate in the second copy of these bases.
_PIECES = f"""{_PLANTED}, tails AS (SELECT CAST(doc_id AS VARCHAR) AS chrom, translate(string_agg(md5(doc_id || ':end:' || i), '' ORDER BY i), '{_HEX}', '{_HEX_BASES}') AS tail FROM documents, unnest(range(0, 12)) AS t(i) GROUP BY doc_id),
long AS (SELECT chrom, seq || substr(seq, 1, 400) || tail AS seq, length(seq) AS n FROM chroms JOIN tails USING (chrom)),
pieces AS (SELECT chrom, i AS spot FROM long, unnest(range(400, n - 299, 400)) AS t(i) UNION ALL SELECT chrom, n + 300 FROM long)"""


def _pieces(spark, sf_dir):
    tail = F.translate(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.md5(F.concat_ws(":", "chrom", F.lit("end"), i))), ""), _HEX, _HEX_BASES)
    chroms = _planted(spark, sf_dir)[1].withColumn("n", F.length("seq"))
    chroms = chroms.select("chrom", "n", F.concat("seq", F.substr("seq", F.lit(1), F.lit(400)), tail).alias("seq"))
    spots = F.concat(F.when(F.col("n") >= 700, F.sequence(F.lit(400), F.col("n") - 300, F.lit(400))).otherwise(F.array().cast("array<int>")), F.array(F.col("n") + 300))
    return chroms.select("chrom", "seq", F.explode(spots).alias("spot")), chroms.select("chrom", "seq")


@query(f"""
WITH {_PIECES}, mates AS (SELECT chrom, spot, unnest([1, 2]) AS mate FROM pieces)
SELECT chrom || ':' || spot AS pair, mate, chrom, CAST(spot + CASE mate WHEN 1 THEN 1 ELSE 201 END AS INT) AS pos, CASE mate WHEN 1 THEN '+' ELSE '-' END AS strand, '100=' AS cigar, true AS proper, 300 AS size FROM mates
""")
def paired_mapping(spark, sf_dir):
    """Pairs come back to their pieces, also where one mate alone would go to the first copy of a repeat."""
    pieces, chroms = _pieces(spark, sf_dir)
    at = lambda start: F.substr("seq", F.col("spot") + start, F.lit(100))
    mates = F.array(F.struct(F.lit(1).alias("mate"), at(1).alias("seq")), F.struct(F.lit(2).alias("mate"), fx.revcomp(at(201)).alias("seq")))
    reads = pieces.select(F.concat_ws(":", "chrom", "spot").alias("pair"), F.explode(mates).alias("x")).select("pair", "x.*")
    places = cut_lineage(mapping.candidate_places(reads, chroms, ["pair", "mate"]))
    return mapping.pair_places(places, reads, chroms, ["pair"]).select("pair", "mate", "chrom", "pos", "strand", "cigar", "proper", "size")


#: The adapters behind both mates' pieces.
BEHIND = ("AGATCGGAAGAGCACACGTCTGAACTCCAGTCA", "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT")


@query(f"""
WITH {_PLANTED} SELECT read, CAST(least(100, 80 + (spot // 400 * 7 + length(chrom)) % 40) AS INT) AS kept1, CAST(least(100, 80 + (spot // 400 * 7 + length(chrom)) % 40) AS INT) AS kept2 FROM planted
""")
def clip_palindromes(spark, sf_dir):
    """Pairs of 100 bases of pieces of 80 to 119, with the adapters behind: those that are read through are cut at the piece's end."""
    chroms = _planted(spark, sf_dir)[1]
    spots = chroms.select("chrom", "seq", F.explode(F.sequence(F.lit(0), F.length("seq") - 120, F.lit(400))).alias("spot"))
    size = (80 + (F.floor(F.col("spot") / 400) * 7 + F.length("chrom")) % 40).cast("int")
    pieces = spots.select(F.concat_ws(":", "chrom", "spot").alias("read"), F.substr("seq", F.col("spot") + 1, size).alias("piece"))
    sides = [F.substr(F.concat(x, F.lit(a)), F.lit(1), F.lit(100)).alias(f"seq{m}") for m, x, a in ((1, F.col("piece"), BEHIND[0]), (2, fx.revcomp(F.col("piece")), BEHIND[1]))]
    pairs = pieces.select("read", *sides).withColumns({f"qual{m}": F.repeat(F.lit("I"), F.lit(100)) for m in (1, 2)})
    return pairing.clip_palindromes(pairs, BEHIND).select("read", F.length("seq1").alias("kept1"), F.length("seq2").alias("kept2"))


# --- stored alignments -----------------------------------------------------------------------

_LAID = "SELECT 's' || l_suppkey % 10 AS chrom, l_orderkey AS pos, l_orderkey + CAST(l_quantity AS BIGINT) AS \"end\", l_linenumber FROM lineitem"


def _stored(spark, sf_dir):
    rows = read_table(spark, sf_dir, "lineitem").select(F.concat(F.lit("s"), F.col("l_suppkey") % 10).alias("chrom"), F.col("l_orderkey").alias("pos"), (F.col("l_orderkey") + F.col("l_quantity").cast("long")).alias("end"), "l_linenumber")
    path = scratch_folder(spark)
    alignments.write_alignments(rows, path, files=16, bin_size=256)
    return path


@query(f"WITH a AS ({_LAID}) SELECT * FROM a WHERE chrom = 's3' AND pos <= 700 AND \"end\" >= 500")
def stored_region(spark, sf_dir):
    """Line items as stretches of contigs, stored in order with an index, and those that touch a region."""
    return alignments.read_region(spark, _stored(spark, sf_dir), "s3", 500, 700)


@query(f"WITH a AS ({_LAID}), r AS (SELECT c_custkey, 's' || c_nationkey % 10 AS chrom, c_custkey * 3 AS start, c_custkey * 3 + 600 AS stop FROM customer) SELECT c_custkey, count(*) AS n, min(pos) AS first, max(\"end\") AS last FROM r JOIN a ON a.chrom = r.chrom AND pos <= stop AND \"end\" >= start GROUP BY c_custkey")
def stored_regions(spark, sf_dir):
    """How many stored stretches touch each customer's region."""
    regions = read_table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("s"), F.col("c_nationkey") % 10).alias("chrom"), (F.col("c_custkey") * 3).alias("start"), (F.col("c_custkey") * 3 + 600).alias("stop"))
    found = alignments.read_regions(spark, _stored(spark, sf_dir), regions, bin_size=256)
    return found.groupBy("c_custkey").agg(F.count("*").alias("n"), F.min("pos").alias("first"), F.max("end").alias("last"))


# --- growing alignments ----------------------------------------------------------------------

#: A pair for each document: its source's common sequence (of the first document of 500 to 1000 bases), in which the document puts up
#: to four of its letters after one place and lacks another.
_PAIRS = f"""{_DOCS}, centers AS (SELECT source, min_by(seq, doc_id) AS center FROM docs WHERE length(seq) BETWEEN 500 AND 1000 GROUP BY source),
edits AS (SELECT doc_id, source, center, substr(seq, 1, CAST(doc_id % 5 AS INT)) AS put, CAST(doc_id * 7919 % (length(center) + 1) AS INT) AS spot, CAST(doc_id * 104729 % length(center) AS INT) AS lack FROM docs JOIN centers USING (source))"""


@query(f"""
WITH {_PAIRS}, widest AS (SELECT source, spot, max(length(put)) AS size FROM edits GROUP BY source, spot),
cells AS (SELECT doc_id, e.source, i, center[i + 1] AS letter, CASE WHEN i = lack AND i < length(center) THEN '-' ELSE center[i + 1] END AS own, CASE WHEN i = e.spot THEN put ELSE '' END AS put, coalesce(size, 0) AS size
  FROM edits e, unnest(range(0, length(center) + 1)) AS t(i) LEFT JOIN widest w ON w.source = e.source AND w.spot = i)
SELECT doc_id, md5(string_agg(put || repeat('-', size - length(put)) || own, '' ORDER BY i)) AS merged, md5(string_agg(repeat('-', size) || letter, '' ORDER BY i)) AS common, CAST(sum(size) + max(i) AS INT) AS width FROM cells GROUP BY doc_id
""")
def merge_pairs(spark, sf_dir):
    """Pairwise alignments with each source's common sequence as one alignment of the source."""
    docs = _sequences(spark, sf_dir)
    centers = docs.filter(F.length("seq").between(500, 1000)).groupBy("source").agg(F.min_by("seq", "doc_id").alias("center"))
    at, lack = (F.pmod(F.col("doc_id") * n, F.length("center") + more).cast("int") for n, more in ((7919, 1), (104729, 0)))
    edits = gapmap.join_by_parts(docs, centers, ["source"]).withColumns({"put": F.expr("substr(seq, 1, int(doc_id % 5))"), "at": at, "lack": lack})
    holed = F.concat(F.substr("center", F.lit(1), F.col("lack")), F.lit("-"), F.substr("center", F.col("lack") + 2))
    opened = lambda text, new: F.concat(F.substr(text, F.lit(1), F.col("at")), new, F.substr(text, F.col("at") + 1))
    pairs = edits.select("doc_id", "source", opened(F.col("center"), F.repeat(F.lit("-"), F.length("put"))).alias("a"), opened(holed, F.col("put")).alias("b"))
    merged = gapmap.merge_pairs(pairs, ["source"])
    return merged.select("doc_id", F.md5("merged").alias("merged"), F.md5("common").alias("common"), F.length("merged").alias("width"))


#: Two samples for each document of 400 bases or more, as its family: one with letters put in, one that lacks some.
_SAMPLES = f"""{_DOCS}, rows AS (
  SELECT doc_id, 0 AS row_ord, seq FROM docs WHERE length(seq) >= 400
  UNION ALL SELECT doc_id, 1, substr(seq, 1, CAST(length(seq) // 2 AS INT)) || 'GATTACA' || substr(seq, CAST(length(seq) // 2 AS INT) + 1) FROM docs WHERE length(seq) >= 400
  UNION ALL SELECT doc_id, 2, substr(seq, 1, CAST(length(seq) // 4 AS INT)) || substr(seq, CAST(length(seq) // 4 AS INT) + 6) FROM docs WHERE length(seq) >= 400)"""


@query(f"""
WITH {_SAMPLES} SELECT doc_id, CAST(row_ord AS BIGINT) AS row_ord, ['>reference', '>more', '>less'][row_ord + 1] AS header, md5(seq) AS letters, CAST(max(length(seq)) FILTER (row_ord = 1) OVER (PARTITION BY doc_id) AS INT) AS width FROM rows
""")
def growing_alignment(spark, sf_dir):
    """Each document's bases as a family, to whose alignment two samples are added: every letter comes back."""
    docs = cut_lineage(_sequences(spark, sf_dir).filter(F.length("seq") >= 400).select(F.col("doc_id").alias("family"), "seq"))
    n = F.length("seq")
    half, quarter = (F.floor(n / x).cast("int") for x in (2, 4))
    more = F.concat(F.substr("seq", F.lit(1), half), F.lit("GATTACA"), F.substr("seq", half + 1))
    less = F.concat(F.substr("seq", F.lit(1), quarter), F.substr("seq", quarter + 6))
    store = scratch_folder(spark)
    growing.start_alignments(store, docs.withColumn("header", F.lit(">reference")))
    for header, seq in ((">more", more), (">less", less)):
        growing.add_samples(spark, store, docs.select("family", F.lit(header).alias("header"), seq.alias("seq")), pipelines.Settings(circular=False))
    rows = growing.rows_at(spark, store)
    return rows.select(F.col("family").alias("doc_id"), "row_ord", "header", F.md5(F.replace("seq_aln", F.lit("-"), F.lit(""))).alias("letters"), F.length("seq_aln").alias("width"))


#: For each document a family whose reference has 512 bases, and a sample with reads of it whose contig has one base wrong; a tenth of the families
#: have another sample with other bases, and each one that fails: an empty contig, none, no reads, a letter that is none, or no family.
_FAILS = "['empty', 'lost', 'mute', 'bad', 'stray']"
_RUN = f"""fam AS (SELECT doc_id, translate(string_agg(md5(doc_id || ':run:' || i), '' ORDER BY i), '{_HEX}', '{_HEX_BASES}') AS seq FROM documents, unnest(range(0, 16)) AS t(i) GROUP BY doc_id),
said AS (
  SELECT 's' || doc_id || ':good' AS sample, s.* FROM fam, (VALUES ('input', 'ok', 17.0), ('mapping', 'ok', 17.0), ('correction', 'ok', 1.0), ('alignment', 'accepted', 1.0)) AS s(stage, status, amount)
  UNION ALL SELECT 's' || doc_id || ':other', s.* FROM fam, (VALUES ('input', 'ok', 17.0), ('mapping', 'ok', 17.0), ('correction', 'ok', 0.0), ('alignment', 'rejected', 0.0)) AS s(stage, status, amount) WHERE doc_id % 10 = 0
  UNION ALL SELECT 's' || doc_id || ':' || {_FAILS}[CAST(doc_id % 5 AS INT) + 1], 'input', ['empty contig', 'no contig', 'no reads', 'bad letters', 'no family'][CAST(doc_id % 5 AS INT) + 1], CASE WHEN doc_id % 5 = 2 THEN 0.0 ELSE 17.0 END FROM fam)"""


@query(f"WITH {_RUN} SELECT sample, stage, status, CAST(amount AS DOUBLE) AS amount FROM said")
def whole_run(spark, sf_dir):
    """The whole run over a family for each document: samples that fail are told by stage, the others go on."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    made = lambda mark: F.translate(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.md5(F.concat_ws(":", "doc_id", F.lit(mark), i))), ""), _HEX, _HEX_BASES)
    fam = docs.select("doc_id", F.concat(F.lit("f"), "doc_id").alias("family"), made("run").alias("seq"), made("other").alias("other"))
    kind = F.element_at(F.array(*map(F.lit, ("empty", "lost", "mute", "bad", "stray"))), (F.col("doc_id") % 5 + 1).cast("int"))
    wrong = F.concat(F.substr("seq", F.lit(1), F.lit(200)), F.translate(F.substr("seq", F.lit(201), F.lit(1)), "ACGT", "CGTA"), F.substr("seq", F.lit(202)))
    sample = lambda name: F.concat(F.lit("s"), "doc_id", F.lit(":"), name).alias("sample")
    good = fam.select(sample(F.lit("good")), "family", wrong.alias("seq"), F.col("seq").alias("true"))
    other = fam.filter("doc_id % 10 = 0").select(sample(F.lit("other")), "family", F.col("other").alias("seq"), F.col("other").alias("true"))
    fails = fam.select(sample(kind), F.when(kind == "stray", "nowhere").otherwise(F.col("family")).alias("family"), F.when(kind == "empty", "").when(kind == "bad", "ACGT!").otherwise(F.col("seq")).alias("seq"), F.col("seq").alias("true"))
    every = good.unionByName(other).unionByName(fails)
    reads = every.filter(~F.endswith("sample", F.lit(":mute"))).select("sample", F.lit(1).alias("mate"), F.explode(F.sequence(F.lit(0), F.lit(400), F.lit(25))).alias("read_idx"), "true")
    reads = reads.select("sample", "mate", "read_idx", F.substr("true", F.col("read_idx") + 1, F.lit(100)).alias("seq"), F.repeat(F.lit("I"), F.lit(100)).alias("qual"))
    contigs = every.filter(~F.endswith("sample", F.lit(":lost"))).select("sample", "family", "seq")
    said = growing.run_samples(spark, reads, contigs, fam.select("family", F.lit(">reference").alias("header"), "seq"), scratch_folder(spark), pipelines.Settings(circular=False))
    return said.select("sample", "stage", "status", F.when(F.col("stage") == "alignment", (F.col("amount") >= 0.95).cast("double")).otherwise(F.col("amount")).alias("amount"))
