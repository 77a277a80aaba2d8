"""Language identification with interpolated Kneser-Ney character models (operator 7)."""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thylakoid.llm.common import carried, map_texts, materialize, scratch_folder

ORDER = 5
#: The models learn from about so many documents of a language, of at most so many bytes each; one in
#: CALIBRATE of these is kept for calibration. Languages are bounded too: each adds a column to the tables.
SAMPLE_DOCS, SAMPLE_BYTES, CALIBRATE, MOST_LANGS = 1500, 200_000, 5, 500
#: Documents that all languages together are learned from at most, and n-grams of whole languages that come to the driver at a time.
SAMPLE_TOTAL, FETCH_ROWS = 60_000, 1 << 21
#: Longer runs of letters count as several words, so what a word takes is bounded.
MOST_LETTERS = 64
#: Words whose scores a worker remembers.
CACHE_WORDS = 300_000
UNDETERMINED = "und"
#: The share of a language's texts that may be rejected, the calibration texts that a length band needs
#: for a limit of its own, the bands (each twice as long as the one before) and the first words that
#: stand for short texts.
FALSE_REJECTION, LEAST_BAND, BANDS, FIRST_WORDS = 0.001, 30, 20, (1, 2, 4, 8, 16, 32, 64, 128)

_RUN = re.compile(r"[^\W\d_]{1,%d}" % MOST_LETTERS)
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BEGIN, _END = 2, 3


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of word characters; what isn't a letter in them is taken out later."""
    return _RUN.findall(text.lower()) if text else []


def _letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


class _Grams:
    """Character n-grams of some words, each between a begin and an end mark, as rolling hashes."""

    def __init__(self, words: list[str]):
        size = np.fromiter(map(len, words), np.int64, len(words)) + 2
        start = np.cumsum(size) - size
        code = np.zeros(int(size.sum()), np.uint32)
        inner = np.ones(len(code), bool)
        inner[start] = inner[start + size - 1] = False
        code[inner] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        code[start], code[start + size - 1] = _BEGIN, _END
        self.word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        self.place = (np.arange(len(code)) - np.repeat(start, size)).astype(np.int32)
        x = code.astype(np.uint64) * _MIX
        self.one = x ^ (x >> np.uint64(29))
        self.keys = {0: np.zeros(len(code), np.uint64), 1: self.one}
        for n in range(2, ORDER + 1):
            self.keys[n] = self.one.copy()
            self.keys[n][1:] += self.keys[n - 1][:-1] * _STEP  # of the n symbols that end here


class CharModel:
    """One language's model: for each order sorted hashes of its n-grams with their log-probability, and sorted
    hashes of its contexts with the log of what they leave to the next lower order."""

    def __init__(self, grams: dict[int, tuple[np.ndarray, ...]], symbols: int):
        """``grams``: for each order the language's n-grams' sorted hashes, their contexts' and their lower orders' hashes, and their
        discounted shares of the context; an n-gram's lower order is there too. ``symbols``: how many all languages have."""
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.leaves: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lower = uniform = 1.0 / (symbols + 1)
        for n in range(1, ORDER + 1):
            ids, context, low, share = grams[n]
            ctx, which = np.unique(context, return_inverse=True)
            left = np.ones(len(ctx))
            np.subtract.at(left, which, share)
            left = np.clip(left, 1e-9, 1)
            if n > 1:
                lower = below[1][np.searchsorted(below[0], low)]
            p = share + left[which] * lower
            below = (ids, p)
            self.tables[n] = (ids, np.log(p).astype(np.float32))
            self.leaves[n] = (ctx, np.log(left).astype(np.float32))
        self.unknown = np.float32(np.log(uniform)) + (self.leaves[1][1][0] if len(self.leaves[1][1]) else 0)

    def score(self, grams: _Grams, at: np.ndarray, top: np.ndarray) -> np.ndarray:
        """Log-probabilities of the symbols at some places, each after ``top - 1`` symbols at most."""
        out, open_ = np.zeros(len(at), np.float32), np.arange(len(at))
        for n in range(ORDER, 0, -1):
            mine = open_[top[open_] >= n]
            if not len(mine):
                continue
            ids, logp = self.tables[n]
            row, hit = _found(ids, grams.keys[n][at[mine]])
            out[mine[hit]] += logp[row[hit]]
            rest = mine[~hit]
            open_ = np.concatenate([open_[top[open_] < n], rest])
            if n == 1:
                out[rest] += self.unknown
            elif len(rest):
                ids, left = self.leaves[n]
                row, hit = _found(ids, grams.keys[n - 1][at[rest] - 1])
                out[rest[hit]] += left[row[hit]]
        return out


def _found(ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where keys would lie in sorted ids, and whether they are there."""
    if not len(ids):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    row = np.minimum(np.searchsorted(ids, keys), len(ids) - 1)
    return row, ids[row] == keys


class CharModels:
    """The models of all languages, and how their scores are calibrated."""

    def __init__(self, langs: list[str], models: list[CharModel]):
        self.langs, self.models = langs, models
        self.temperature, self.limits = 1.0, np.full((len(langs), BANDS), np.inf)

    def score(self, words: list[str]) -> np.ndarray:
        """For each word the log-probability in every language, and the number of symbols, as columns."""
        grams = _Grams([_letters(w) for w in words])
        at = np.flatnonzero(grams.place > 0)
        top = np.minimum(grams.place[at] + 1, ORDER)
        word = grams.word[at]
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        size = np.diff(np.r_[first, len(word)]).astype(np.float32)
        size[size == 1] = 0  # no letter in it
        sums = [np.add.reduceat(model.score(grams, at, top), first) for model in self.models]
        return np.stack([*sums, size], axis=1) * (size > 0)[:, None]


def posterior(entropy: np.ndarray, temperature: float) -> np.ndarray:
    """Probabilities of the languages, from cross-entropies."""
    x = -entropy / temperature
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def band_of(size: np.ndarray) -> np.ndarray:
    """The length band of texts of so many symbols."""
    return np.log2(np.clip(size, 1, 2.0 ** (BANDS - 1))).astype(np.int64)


def entropy_limits(bands: list, langs: int) -> np.ndarray:
    """For each language and length band the cross-entropy above which a text is rejected.

    ``bands`` holds the language's number, the band, its texts and their median and upper quartile. These
    tell where ``FALSE_REJECTION`` of the texts lie above, if their tail thins as an exponential one or
    faster; the quartile counts as a twentieth above the median at least. So junk has no say unless it is
    a quarter of a band. A band of few texts takes the limit of the next shorter one, and the shortest
    ones have none.
    """
    halvings, limits = np.log2(0.5 / FALSE_REJECTION), np.full((langs, BANDS), np.inf)
    known = {(lang, band): (middle, quartile) for lang, band, n, (middle, quartile) in bands if n >= LEAST_BAND}
    for i in range(langs):
        for b in range(BANDS):
            if (i, b) in known:
                middle, quartile = known[i, b]
                limits[i, b] = middle + halvings * max(quartile - middle, middle / 20)
            elif b:
                limits[i, b] = limits[i, b - 1]
    return limits


class _Scorer:
    """Scores of texts from remembered scores of words."""

    def __init__(self, models: CharModels):
        self.models, self.rows = models, {}
        self.table = np.zeros((0, len(models.langs) + 1), np.float32)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats a symbol in every language, and the symbols of each text."""
        cut = [words_of(t) for t in texts]
        wanted = set().union(*cut)
        if len(self.rows) + len(wanted) > CACHE_WORDS:
            self.rows, self.table = {}, self.table[:0]
        new = [w for w in wanted if w not in self.rows]
        scores = [self.models.score(new[i : i + 20_000]) for i in range(0, len(new), 20_000)]
        self.rows.update(zip(new, range(len(self.table), len(self.table) + len(new))))
        self.table = np.concatenate([self.table, *scores])
        get = self.rows.__getitem__
        sums = np.array([self.table[list(map(get, ws))].sum(axis=0, dtype=np.float64) if ws else np.zeros(self.table.shape[1]) for ws in cut])
        size = sums[:, -1]
        return -sums[:, :-1] / np.maximum(size, 1)[:, None], size


_scorers: dict[str, _Scorer] = {}


def _scorer(key: str, models) -> _Scorer:
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = _Scorer(models.value)
    return _scorers[key]


def _forget() -> None:
    _scorers.clear()


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 1 when divided by 3; never learned from. False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _count_grams(batches):
    """(language number, word, count) -> the n-grams of all orders, added up batch by batch."""
    for batch in batches:
        lang, count = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
        grams = _Grams(batch.column(1).to_pylist())
        for n in range(1, ORDER + 1):
            at = np.flatnonzero(grams.place >= max(n - 1, 1))
            key, mine = grams.keys[n][at], lang[grams.word[at]]
            order = np.lexsort((mine, key))
            key, mine = key[order], mine[order]
            edge = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (mine[1:] != mine[:-1])]) if len(key) else at
            first = at[order[edge]]
            lower = grams.keys[n - 1]
            columns = {
                "lang": mine[edge],
                "n": np.full(len(edge), n, np.int32),
                "gram": key[edge].view(np.int64),
                "context": lower[first - 1].view(np.int64),
                "low": lower[first].view(np.int64),
                "begins": grams.place[first] < n,
                "count": np.add.reduceat(count[grams.word[at[order]]], edge) if len(edge) else edge,
            }
            yield pa.RecordBatch.from_pydict(columns)


def char_models(words: DataFrame, folder: str | None = None, fetch_rows: int = FETCH_ROWS) -> CharModels | None:
    """Models of the languages of ``words`` (``lang, word, n``); None if there are no words.

    Spark counts the n-grams of each language: as often as they occur if they are of the highest order or
    begin a word, else in how many different (n+1)-grams they end. It takes the discount of each language
    and order from the n-grams that count once and twice, and divides by the context's total. Only the
    finished shares come to the driver, about ``fetch_rows`` at a time, of whole languages; each language keeps all
    of its n-grams, in arrays of its own.
    """
    spark = words.sparkSession
    folder = folder or scratch_folder(spark)
    langs = sorted(r.lang for r in words.select("lang").distinct().toLocalIterator())
    if not langs:
        return None
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    cut = words.select(number[F.col("lang")].alias("lang"), "word", "n")
    found = cut.mapInArrow(_count_grams, "lang int, n int, gram long, context long, low long, begins boolean, count long")
    found = materialize(found.groupBy("lang", "n", "gram").agg(F.first("context").alias("context"), F.first("low").alias("low"), F.first("begins").alias("begins"), F.sum("count").alias("seen")), folder)
    own = found.select("lang", "n", "gram", "context", "low", "seen", F.when((F.col("n") == ORDER) | F.col("begins"), F.col("seen")).otherwise(0).alias("count"))
    ends = found.filter("n > 1").select("lang", (F.col("n") - 1).alias("n"), F.col("low").alias("gram"), F.lit(1).cast("long").alias("count"))
    counts = own.unionByName(ends, allowMissingColumns=True).groupBy("lang", "n", "gram").agg(F.max("context").alias("context"), F.max("low").alias("low"), F.sum("seen").alias("seen"), F.sum("count").alias("count"))
    counts = materialize(counts, folder)
    once, twice = F.count_if(F.col("count") == 1), F.count_if(F.col("count") == 2)
    discounts = counts.groupBy("lang", "n").agg(F.when(once > 0, F.greatest(F.least(once / (once + 2 * twice), F.lit(0.95)), F.lit(0.1))).otherwise(0.5).alias("discount"))
    total = F.sum("count").over(Window.partitionBy("lang", "n", "context"))
    share = F.greatest(F.col("count") - F.col("discount"), F.lit(0.0)) / F.col("total")
    shares = counts.withColumn("total", total).join(F.broadcast(discounts), ["lang", "n"])  # a row for each language and order
    shares = materialize(shares.select("lang", "n", "gram", "context", "low", share.alias("share")), folder)
    symbols = shares.filter("n = 1").select("gram").distinct().count()
    sizes = {r.lang: r["count"] for r in shares.groupBy("lang").count().toLocalIterator()}
    models: dict[int, CharModel] = {}
    while len(models) < len(langs):
        some = [len(models)]
        while some[-1] + 1 < len(langs) and sum(sizes[i] for i in [*some, some[-1] + 1]) <= fetch_rows:
            some.append(some[-1] + 1)
        rows = shares.filter(F.col("lang").isin(some)).toArrow()
        for i in some:
            own, grams = rows.filter(pc.equal(rows["lang"], i)), {}
            for n in range(1, ORDER + 1):
                table = own.filter(pc.equal(own["n"], n))
                gram, context, low = (table[c].to_numpy().view(np.uint64) for c in ("gram", "context", "low"))
                order = np.argsort(gram)
                grams[n] = (gram[order], context[order], low[order], table["share"].to_numpy()[order])
            models[i] = CharModel(grams, symbols)
    return CharModels(langs, list(models.values()))


def _word_counts(batch: pa.RecordBatch) -> dict:
    counts = Counter()
    for lang, text in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()):
        counts.update((lang, w) for w in map(_letters, words_of(text)) if w)
    return {"lang": pa.array([k[0] for k in counts], pa.string()), "word": pa.array([k[1] for k in counts], pa.string()), "n": pa.array(list(counts.values()), pa.int64())}


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES, sample_total: int = SAMPLE_TOTAL) -> CharModels | None:
    """Models from a bounded sample of labelled rows: about ``sample_docs`` documents a language and ``sample_total`` of all, chosen
    by a hash of the id among those of at most ``sample_bytes``; of more than ``MOST_LANGS`` languages, the
    most frequent ones. One in ``CALIBRATE`` documents isn't learned from, unless its language has no
    others: it sets the scores' temperature and, with its texts' first words as short texts, the
    cross-entropies above which texts are rejected. Rows with a null id, text or language aren't used.
    None if there is nothing to learn from."""
    spark = labelled.sparkSession
    folder = scratch_folder(spark)
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    rows = rows.filter((F.octet_length("text") <= sample_bytes) & F.col("text").rlike(r"\p{L}"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGS).toLocalIterator()}
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, min(sample_docs, sample_total / len(sizes)) / n))])
    draw = (F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)) < share[F.col("lang")]
    sample = materialize(rows.filter(draw).withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(CALIBRATE))), folder)
    known = [r.lang for r in sample.filter("part > 0").select("lang").distinct().toLocalIterator()]
    learned = sample.filter((F.col("part") > 0) | ~F.col("lang").isin(known)) if known else sample
    words = map_texts(learned.select("id", "text", "lang"), _word_counts, {"lang": "string", "word": "string", "n": "long"})
    models = char_models(materialize(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), folder), folder)
    if models is None:
        return None
    key, shared, heats = uuid.uuid4().hex, spark.sparkContext.broadcast(models), np.geomspace(0.005, 2, 25)
    number = {lang: i for i, lang in enumerate(models.langs)}

    def measure(batch: pa.RecordBatch) -> dict:
        texts, truth = [], []
        for text, name in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = words_of(text)
            short = [" ".join(words[:n]) for n in FIRST_WORDS if n < len(words)]
            texts += [text, *short]
            truth += [number.get(name), *[None] * len(short)]
        entropy, size = _scorer(key, shared).entropies(texts)
        whole = np.array([i for i, t in enumerate(truth) if t is not None], np.int64)
        right = np.array([truth[i] for i in whole], np.int64)
        loss = np.array([-np.log(np.maximum(posterior(entropy[whole], heat)[np.arange(len(whole)), right], 1e-9)) for heat in heats]).T
        losses: list = [None] * len(texts)
        for i, x in zip(whole.tolist(), loss.tolist()):
            losses[i] = x
        return {"best": pa.array(entropy.argmin(axis=1), pa.int32()), "band": pa.array(band_of(size), pa.int32()), "size": pa.array(size, pa.float64()), "least": pa.array(entropy.min(axis=1)), "losses": pa.array(losses, pa.list_(pa.float64()))}

    kinds = {"best": "int", "band": "int", "size": "double", "least": "double", "losses": "array<double>"}
    tried = materialize(map_texts(sample.filter("part = 0").select("id", "text", "lang"), measure, kinds, after=_forget).filter("size > 0"), folder)
    shared.destroy()
    bands = tried.groupBy("best", "band").agg(F.count("*").alias("n"), F.percentile("least", F.array(F.lit(0.5), F.lit(0.75))).alias("at"))
    models.limits = entropy_limits([tuple(r) for r in bands.toLocalIterator()], len(models.langs))
    mean = {r.pos: r.loss for r in tried.select(F.posexplode("losses").alias("pos", "loss")).groupBy("pos").agg(F.avg("loss").alias("loss")).toLocalIterator()}
    if mean:
        models.temperature = float(heats[min(sorted(mean), key=mean.get)])
    return models


def identify(docs: DataFrame, models: CharModels | None, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """The language of every whole text.

    Returns one row per input row: the id column, ``lang_pred`` (that of the lowest cross-entropy per
    symbol; of equal ones the first by name; ``und`` if the text is null or has no letter, or nothing
    was learned), ``score`` (calibrated, 0 to 1; 0 with ``und``), ``entropy`` (nats a symbol, null with
    ``und``) and ``rejected`` (no letter, or a cross-entropy above what all but ``FALSE_REJECTION`` of the
    language's texts of that length have; only the former if nothing was learned). With ``carry``, the
    whole input row comes along as the struct ``row``; else other columns aren't read. Repeated rows and
    null ids stay.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col), F.col(text_col), *carried(docs, carry))
    kinds = dict(rows.dtypes)
    key, shared = uuid.uuid4().hex, spark.sparkContext.broadcast(models)

    def run(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        if shared.value is None:
            return {id_col: batch.column(0), "row": batch.column(2 if carry else 0), "lang_pred": [UNDETERMINED] * n, "score": np.zeros(n), "entropy": pa.nulls(n, pa.float64()), "rejected": [not any(map(_letters, words_of(t))) for t in batch.column(1).to_pylist()]}
        entropy, size = _scorer(key, shared).entropies(batch.column(1).to_pylist())
        best, known = entropy.argmin(axis=1), size > 0
        least = entropy[np.arange(n), best]
        score = posterior(entropy, shared.value.temperature)[np.arange(n), best]
        return {
            id_col: batch.column(0),
            "row": batch.column(2 if carry else 0),
            "lang_pred": pa.array([shared.value.langs[b] if k else UNDETERMINED for b, k in zip(best, known)], pa.string()),
            "score": pa.array(np.where(known, score, 0.0)),
            "entropy": pa.array(least, mask=~known),
            "rejected": pa.array(~known | (least > shared.value.limits[best, band_of(size)])),
        }

    out = {id_col: kinds[id_col], "lang_pred": "string", "score": "double", "entropy": "double", "rejected": "boolean"}
    return map_texts(rows, run, out | ({"row": kinds["row"]} if carry else {}), after=_forget)
