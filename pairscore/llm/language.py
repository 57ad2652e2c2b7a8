"""Language identification by Bayesian evidence fusion.

Every kind of evidence is a factor, and the sum of the logs gives the posterior over the languages:

* text: a naive Bayes model over hashed byte trigrams (case folded);
* declared markup language, and address suffix: P(value | language), from joint counts over all rows, against the language
  that the text alone suggests;
* host: the prior P(language | host), shrunk by pseudo-counts to that of the host's domain (its last two labels), and that
  to the global shares.

Declared values are compared by their primary subtag in lower case ('EN-us' is 'en'). The languages are the declared tags of
the most rows, ``MOST_LANGUAGES`` at most; the rows of all other tags make up one more class, whose rows keep what they
declare. So junk declarations, however many, change neither the driver's memory nor a row's size. ``documents`` have no
address: their suffix factor is 1. All counts are grouped aggregations over every row; only the text model is fitted on a
bounded sample of each language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, by_bytes, store, text_bytes

GRAM_BITS = 15
#: Rows the text model is fitted on (those of each language with the smallest hash of their key, as many of each), and
#: rows of a language that there is always room for.
SAMPLE_ROWS, LEAST_ROWS = 4000, 100
#: Languages with a model of their own (ISO 639-1 has 183); the class of all others, and its language where none is declared.
MOST_LANGUAGES, REST, UNKNOWN = 256, "*", "und"
#: Trigrams overlap; each counts this much of an independent observation.
TEXT_WEIGHT = 0.3
PSEUDO = 20.0


@dataclass
class TextModel:
    languages: list[str]
    log_p: np.ndarray  # a row for each language


def grams(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed trigrams of all rows, row of each, letters by row). Digits and ASCII marks count as blanks, and
    trigrams within blanks are left out; a row is framed by blanks."""
    data, bounds = text_bytes(pc.utf8_lower(pc.fill_null(column, "")))
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    value = np.where(letter, data, 32).astype(np.uint32)
    n = len(value)
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    before = np.append(32, value[:-1]).astype(np.uint32)[:n]
    before[first[:-1]] = 32
    after = np.append(value[1:], 32).astype(np.uint32)[:n]
    after[first[1:]] = 32
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    code = (before << np.uint32(16)) | (value << np.uint32(8)) | after
    hashed = (code * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS)
    letters = np.bincount(row[letter], minlength=len(bounds) - 1)
    return hashed[letter], row[letter], letters


def _sample(rows: DataFrame, each: int, counts: dict[str, int]) -> DataFrame:
    """(label, k) of the ``each`` keys of every label that hash smallest (ties by key), or all, if there are fewer;
    ``rows`` (label, k) are counted by label in ``counts``. Like ``smallest_hashes``, for each label."""
    spark = rows.sparkSession
    shares = {label: min(1.0, 2 * each / n) for label, n in counts.items()}
    order = F.shiftrightunsigned(F.xxhash64("k"), 11)
    parts = []
    while shares:
        bounds = spark.createDataFrame([(x, int(share * (1 << 53))) for x, share in shares.items()], "label string, bound long")
        found = store(rows.join(F.broadcast(bounds), "label").where(order < F.col("bound"))
                      .select("label", "k").distinct(), "language-sample")
        have = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
        done = [x for x, share in shares.items() if share >= 1 or have.get(x, 0) >= each]
        shares = {x: min(1.0, share * 8) for x, share in shares.items() if x not in set(done)}
        if done:
            ended = spark.createDataFrame([(x,) for x in done], "label string")
            parts.append(found.join(F.broadcast(ended), "label", "left_semi"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    place = F.row_number().over(Window.partitionBy("label").orderBy(order, "k"))
    return found.withColumn("place", place).where(F.col("place") <= each).select("label", "k")


def fit_text_model(rows: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE_ROWS) -> TextModel:
    """The labels of the most rows (see MOST_LANGUAGES) and REST for all others, from about ``sample`` rows: of each as many, those whose key hashes smallest, and LEAST_ROWS if
    that is more. Counts are summed in Spark."""
    labelled = rows.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(label).alias("label"), F.col(key).alias("k"))
    counts = labelled.groupBy("label").agg(F.count("*").alias("count"))
    labels = {r["label"]: r["count"] for r in counts.orderBy(F.desc("count"), "label").limit(MOST_LANGUAGES).collect()}
    if not labels:
        return TextModel([], np.zeros((0, 1 << GRAM_BITS), np.float32))
    others = labelled.count() - sum(labels.values())
    if others:
        # the rows of all other labels are one class
        known = F.when(F.col("label").isin(list(labels)), F.col("label")).otherwise(REST)
        labelled, labels[REST] = labelled.withColumn("label", known), others
        rows = rows.withColumn(label, F.when(F.col(label).isNotNull(), F.when(F.col(label).isin(list(labels)), F.col(label)).otherwise(REST)))
    languages = sorted(labels)
    chosen = _sample(labelled, max(LEAST_ROWS, -(-sample // len(languages))), labels)
    picked = rows.select(F.col(key).alias("k"), F.col(text).alias("text"), F.col(label).alias("label")).join(
        F.broadcast(chosen), ["label", "k"], "left_semi").select("text", "label")

    def work(batches):
        for batch in by_bytes(batches, "text"):
            hashed, row, _ = grams(batch.column("text"))
            labels = batch.column("label").dictionary_encode()
            if isinstance(labels, pa.ChunkedArray):
                labels = labels.combine_chunks()
            code = labels.indices.to_numpy()[row].astype(np.int64) * (1 << GRAM_BITS) + hashed
            at, n = np.unique(code, return_counts=True)
            names = np.array(labels.dictionary.to_pylist(), object)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[at >> GRAM_BITS], pa.string()), pa.array(at & ((1 << GRAM_BITS) - 1)), pa.array(n)],
                ["label", "gram", "n"])
    counts = store(picked.mapInArrow(work, "label string, gram long, n long").groupBy("label", "gram")
                   .agg(F.sum("n").alias("n")), "language-counts")
    place = {name: i for i, name in enumerate(languages)}
    table = np.full((len(languages), 1 << GRAM_BITS), 0.5, np.float32)
    got = counts.toArrow()
    at = [place[x] for x in got.column("label").to_pylist()]
    table[at, got.column("gram").to_numpy()] += got.column("n").to_numpy()
    return TextModel(languages, np.log(table / table.sum(1, keepdims=True, dtype=np.float64)).astype(np.float32))


def text_scores(rows: DataFrame, model: TextModel, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, letters, and ``ll``: the weighted log likelihood of the text for each language."""
    table = rows.sparkSession.sparkContext.broadcast(model.log_p)  # at most 257 x 32768 floats, 34 MB
    kinds = [f for f in rows.select(*keep).schema.fields]

    def work(batches):
        log_p = table.value
        for batch in by_bytes(batches, text):
            hashed, row, letters = grams(batch.column(text))
            ll = np.stack([np.bincount(row, p[hashed], batch.num_rows) for p in log_p], 1) * TEXT_WEIGHT
            ll = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1) * len(log_p), pa.array(ll.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(letters, pa.int64()), ll],
                                             [*keep, "letters", "ll"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds) + ", letters long, ll array<double>"
    return rows.select(*keep, text).mapInArrow(work, schema)


def _shrunk(counts: Column, prior: Column, strength: float) -> Column:
    """Shares of ``counts`` shrunk towards ``prior``, both arrays over the languages."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, prior, lambda n, p: (n + strength * p) / (total + strength))


def _small_join(rows: DataFrame, small: DataFrame, key: str | list[str], size: int) -> DataFrame:
    if small.count() <= BROADCAST_IDS // max(50, size):  # some hundred bytes a row, or a number for each language
        small = F.broadcast(small)
    return rows.join(small, key, "left")


def primary_tag(declared: Column) -> Column:
    """The primary subtag of a language tag in lower case: 'EN', 'en-US' and ' en_GB ' are 'en'; '' for NULL."""
    return F.coalesce(F.element_at(F.split(F.lower(F.trim(declared)), "[-_]"), 1), F.lit(""))


def domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def identify(rows: DataFrame, key: str = "doc_id", text: str = "text", declared: str = "lang", host: str = "source",
             suffix: Column | None = None, least: float = 0.5, accept: list[str] | None = None,
             model: TextModel | None = None) -> DataFrame:
    """(key, language, probability, declared, letters, kept) for each of ``rows``.

    ``declared`` is the declared language, ``host`` the host, ``suffix`` the address suffix (default: none). The text
    model is fitted on the declared languages unless given. kept: the text has letters, the posterior reaches
    ``least``, and the language is in ``accept`` (default: any). Where the class of the rare languages is the best, the
    language is the declared one if that is rare, else 'und'.

    A null or empty text, or one without letters, has no language (null, probability 0) and is not kept, whatever is
    declared. A null declaration, suffix or host is an own value of that evidence, and all rare declarations are one.
    Rows that repeat, or have a null key, each count and are each returned. Other columns are ignored. Without any
    labelled row no language is known and nothing is kept; an empty table gives an empty result."""
    base = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(declared).alias("declared"),
                       primary_tag(F.col(declared)).alias("tag"), F.coalesce(F.col(host), F.lit("")).alias("host"),
                       (F.lit("") if suffix is None else F.coalesce(suffix, F.lit(""))).alias("suffix"))
    model = model or fit_text_model(base.withColumn("label", F.nullif("tag", F.lit(""))), "key", "text", "label")
    names = model.languages
    if not names:
        return base.select(F.col("key").alias(key), F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("probability"),
                           "declared", F.lit(0).cast("long").alias("letters"), F.lit(False).alias("kept"))
    said_as = F.when(F.col("tag").isin([*names, ""]), F.col("tag")).otherwise(REST)
    scored = store(text_scores(base.withColumn("said", said_as), model, "text", ["key", "declared", "tag", "said", "host", "suffix"])
                   .withColumn("guess", F.when(F.col("letters") > 0, F.array_position("ll", F.array_max("ll")))), "language-scores")
    size = len(names)
    tally = F.array(*[F.count_if(F.col("guess") == i + 1).cast("double") for i in range(size)])
    # one number a language
    sums = scored.agg(tally).first()[0]
    overall = F.array(*[F.lit((n + 1) / (sum(sums) + size)) for n in sums])

    def likelihood(value: str) -> DataFrame:
        """(value, of_value): P(value | language) with half a count for each value that occurs."""
        counts = store(scored.groupBy(value).agg(tally.alias("n")), f"language-{value}")
        values = counts.count()
        return counts.select(value, F.zip_with("n", F.array(*[F.lit(n) for n in sums]),
                                               lambda n, s: (n + 0.5) / (s + 0.5 * max(1, values))).alias(f"of_{value}"))
    hosts = store(scored.groupBy("host").agg(tally.alias("n")).withColumn("domain", domain(F.col("host"))), "language-hosts")
    totals = F.array(*[F.sum(F.get("n", F.lit(i))) for i in range(size)])
    domains = hosts.groupBy("domain").agg(totals.alias("m")).select("domain", _shrunk(F.col("m"), overall, PSEUDO).alias("of_domain"))
    prior = F.when(F.col("host") == F.col("domain"), _shrunk(F.col("n"), overall, PSEUDO)).otherwise(_shrunk(F.col("n"), F.col("of_domain"), PSEUDO))
    hosts = _small_join(hosts, domains, "domain", size).select("host", prior.alias("prior"))
    joined = _small_join(scored.where("letters > 0"), likelihood("said"), "said", size)
    joined = _small_join(joined, likelihood("suffix"), "suffix", size)
    joined = _small_join(joined, hosts, "host", size)
    log = F.col("ll")
    for factor in ("prior", "of_said", "of_suffix"):
        log = F.zip_with(log, factor, lambda a, p: a + F.log(p))
    scores = joined.withColumn("log", log).withColumn("top", F.array_max("log"))
    scores = scores.withColumn("probability", 1 / F.aggregate(
        F.transform("log", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, x: a + x))
    which = F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position("log", F.col("top")).cast("int"))
    rare = F.when(F.col("said") == REST, F.col("tag")).otherwise(UNKNOWN)
    good = F.col("probability") >= least
    if accept is not None:
        good = good & F.col("language").isin(accept)
    out = scores.withColumn("language", F.when(which == REST, rare).otherwise(which)).withColumn("kept", good)
    none = scored.where("letters = 0").withColumns({"language": F.lit(None).cast("string"), "probability": F.lit(0.0), "kept": F.lit(False)})
    columns = [F.col("key").alias(key), "language", "probability", "declared", "letters", "kept"]
    return out.select(columns).unionByName(none.select(columns))


# ------------------------------------------------------------------------ pages

def page_text(html: Column) -> Column:
    """Text of a page without scripts, styles and tags. The page is cut at each '<', so the work is linear in it, whatever
    its tags; a '<' without a '>' before the next one is text."""
    inside = F.split(html, r"(?i)<(?=/?(?:script|style)\b)")
    shown = F.filter(inside, lambda s, i: (i == 0) | ~s.rlike(r"^(?i:script|style)\b"))
    pieces = F.split(F.array_join(shown, "<"), "<")
    after = lambda s: F.concat(F.lit(" "), F.when(F.contains(s, F.lit(">")), F.substr(s, F.locate(">", s) + 1)).otherwise(s))
    return F.array_join(F.transform(pieces, lambda s, i: F.when(i == 0, s).otherwise(after(s))), "")


def page_language(html: Column) -> Column:
    """The lang attribute of the first html tag, or NULL."""
    tag = F.substring_index(F.get(F.split(html, r"(?i)<html\b", 2), F.lit(1)), ">", 1)
    return F.nullif(F.regexp_extract(tag, r"(?i)\blang=[\"']?([A-Za-z]+)", 1), F.lit(""))
