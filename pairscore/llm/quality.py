"""Quality classification by hierarchical empirical Bayes.

A logistic model over word and word-shape presence gives each document its own evidence, as log odds. Hosts and paths
give more: over all labelled rows, grouped counts of positives yield a posterior for each host, shrunk towards the
global rate, and for each path, shrunk towards its host. The strength of the shrinkage is estimated from the counts
(method of moments), so sparse sites stay near the prior above them. A document's log odds are its evidence plus the
shift of its path's posterior from the global rate.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, by_bytes, hash_ranges, mix, smallest_hashes, split_words, store, text_bytes

#: Rows with a label of a target that its document model is fitted on (smallest hash of their key), and the score above
#: which it selects features.
SAMPLE_ROWS, LEAST_SCORE = 20_000, 8.0
FEATURE_BITS = 18
#: Bytes by kind, for the shape of a word: runs of a kind count once.
_KIND = np.arange(256, dtype=np.uint8)
_KIND[48:58], _KIND[65:91], _KIND[97:123] = 48, 65, 97
_KIND[128:] = 97
_MARK = np.zeros(256, bool)
_MARK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class DocumentModel:
    features: np.ndarray  # hashed features, sorted
    weights: dict[str, np.ndarray]  # by target that has labels: a weight for each feature, then the constant


def features(column) -> tuple[np.ndarray, np.ndarray]:
    """(row, hashed feature) of the words (letters and digits, in lower case) and the shapes of blank-separated words
    of all rows, each feature once a row."""
    data, bounds = text_bytes(pc.fill_null(column, ""))
    kind = _KIND[data]
    start, end, first = split_words(data, bounds)
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[start] = True
    at = np.append(0, np.cumsum(new))
    shapes = hash_ranges(kind[new], at[start], at[end]) ^ np.uint64(0x5A5A5A5A)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    low, lower_bounds = text_bytes(pc.utf8_lower(pc.fill_null(column, "")))
    s, e, f = split_words(low, lower_bounds, _MARK)
    words = hash_ranges(low, s, e)
    more = np.repeat(np.arange(len(bounds) - 1), np.diff(f))
    hashed = (mix(np.concatenate([shapes, words])) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    code = np.unique((np.concatenate([rows, more]) << FEATURE_BITS) + hashed)
    return code >> FEATURE_BITS, code & ((1 << FEATURE_BITS) - 1)


def logistic(row: np.ndarray, feature: np.ndarray, size: int, y: np.ndarray, ridge: float = 1.0, steps: int = 300) -> np.ndarray:
    """Weights and constant of a ridge logistic regression by accelerated gradient steps, over the 0/1 matrix of
    len(y) rows and ``size`` features that is 1 at each (row, feature)."""
    def times(w):
        return np.bincount(row, w[feature], len(y)) + w[-1]

    def back(r):
        return np.append(np.bincount(feature, r[row], size), r.sum())
    w = np.zeros(size + 1)
    v, before = w.copy(), w.copy()
    top = np.ones(size + 1)
    for _ in range(30):  # largest eigenvalue of x'x, by power iteration
        top = back(times(top / np.linalg.norm(top)))
    rate = 4.0 / (1.1 * np.linalg.norm(top) + 4 * ridge)
    for t in range(steps):
        p = 1 / (1 + np.exp(-np.clip(times(v), -30, 30)))
        grad = back(p - y) + ridge * np.append(v[:-1], 0)
        w = v - rate * grad
        v = w + t / (t + 3) * (w - before)
        before = w
    return w


def fit(docs: DataFrame, labels: DataFrame, targets: list[str], sample: int = SAMPLE_ROWS) -> DocumentModel | None:
    """The document model, each target from ``sample`` rows with a label of it; null where no row has a label. Feature
    selection keeps all in at least 5 rows of a target that tell about it, by a chi-square score."""
    chosen = None
    for t in targets:
        usable = labels.select("doc_id", t).where(F.col(t).isNotNull() & F.col("doc_id").isNotNull())
        own = smallest_hashes(usable, "doc_id", sample, 2, lambda df, t=t: df.groupBy("doc_id").agg(F.max(t).alias(t)))
        chosen = own if chosen is None else chosen.join(own, "doc_id", "full")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def work(batches):
        for batch in by_bytes(batches, "text"):
            row, feature = features(batch.column("text"))
            lists = pa.ListArray.from_arrays(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32),
                                             pa.array(feature.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[batch.column(t) for t in targets], lists],
                                             ["doc_id", *targets, "features"])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ["doc_id", *targets]) + ", features array<int>"
    table = store(rows.mapInArrow(work, schema), "quality-sample")
    totals = table.agg(*[F.count(t).alias(f"n_{t}") for t in targets],
                       *[F.sum((F.col(t) > 0).cast("long")).alias(t) for t in targets]).first()
    targets = [t for t in targets if totals[f"n_{t}"]]
    if not targets:
        return None
    counts = (table.select(*targets, F.explode("features").alias("f")).groupBy("f")
              .agg(*[F.count(t).alias(f"n_{t}") for t in targets],
                   *[F.sum((F.col(t) > 0).cast("long")).alias(t) for t in targets])
              .where(" or ".join(f"`n_{t}` >= 5" for t in targets)))

    def score(t):  # squared deviation of the feature's positives from the target's rate, over its variance
        rate, n = totals[t] / totals[f"n_{t}"], F.col(f"n_{t}")
        return F.when(n >= 5, F.pow(F.col(t) - n * rate, 2) / (n * max(rate * (1 - rate), 1e-9)))
    chosen_features = np.zeros(0, np.int64)
    for t in targets:
        best = counts.where(score(t) > LEAST_SCORE).select("f")
        chosen_features = np.union1d(chosen_features, np.array([r["f"] for r in best.collect()], np.int64))

    def pick(batches):  # only the chosen features of a text come to the driver, however long it is
        for batch in batches:
            lists = batch.column("features")
            own = lists.flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            place = np.minimum(np.searchsorted(chosen_features, own), max(0, len(chosen_features) - 1))
            hit = chosen_features[place] == own if len(chosen_features) else np.zeros(len(own), bool)
            bounds = np.searchsorted(row[hit], np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", *targets)], pa.ListArray.from_arrays(bounds, pa.array(own[hit]))],
                                             ["doc_id", *targets, "features"])
    kept = ", ".join(f"`{c}` {kinds[c]}" for c in ["doc_id", *targets]) + ", features array<int>"
    rows = table.select("doc_id", *targets, "features").mapInArrow(pick, kept).orderBy("doc_id", *targets).toArrow()
    n = len(rows)
    lists = rows.column("features").combine_chunks()
    row, own = np.repeat(np.arange(n), lists.value_lengths().to_numpy()), lists.flatten().to_numpy().astype(np.int64)
    at = np.minimum(np.searchsorted(chosen_features, own), len(chosen_features) - 1)
    hit = chosen_features[at] == own if len(chosen_features) else np.zeros(len(own), bool)
    row, at = row[hit], at[hit]
    weights = {}
    for t in targets:
        has = rows.column(t).is_valid().to_numpy()
        y = (rows.column(t).drop_null().to_numpy() > 0).astype(np.float64)
        place, mine = np.cumsum(has) - 1, has[row]
        weights[t] = logistic(place[row[mine]], at[mine], len(chosen_features), y)
    return DocumentModel(chosen_features, weights)


def evidence(docs: DataFrame, model: DocumentModel, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``e_<target>``: the log odds of each document."""
    targets = list(model.weights)
    table = np.zeros((len(targets), 1 << FEATURE_BITS))
    for i, t in enumerate(targets):
        table[i, model.features] = model.weights[t][:-1]
    constants = [float(model.weights[t][-1]) for t in targets]
    kinds = {f.name: f.dataType.simpleString() for f in docs.select(*keep).schema.fields}

    def work(batches):
        for batch in by_bytes(batches, "text"):
            row, feature = features(batch.column("text"))
            odds = [pa.array(np.bincount(row, w[feature], batch.num_rows) + c) for w, c in zip(table, constants)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + odds, [*keep, *[f"e_{t}" for t in targets]])
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"e_{t} double" for t in targets])
    return docs.select(*keep, "text").mapInArrow(work, schema)


def _strength(groups: DataFrame, rate: str) -> float:
    """Pseudo-count of the Beta prior around ``rate`` from groups (n, k), by the method of moments."""
    m = F.col(rate)
    r = groups.agg(F.sum("n").alias("n"), F.count("*").alias("g"), F.sum(F.col("n") * F.col("n")).alias("nn"),
                   F.sum(F.col("n") * (F.col("k") / F.col("n") - m) * (F.col("k") / F.col("n") - m)).alias("s"),
                   F.sum(F.col("n") * m * (1 - m)).alias("v")).first()
    if not r["g"] or r["g"] < 2 or not r["v"]:
        return 100.0
    v = r["v"] / r["n"]
    spread = (r["s"] - (r["g"] - 1) * v) / (r["n"] - r["nn"] / r["n"])
    return float(min(1e4, max(2.0, v / spread - 1))) if spread > 0 else 1e4


def posteriors(rows: DataFrame, target: str) -> tuple[DataFrame, float]:
    """(host, path, <target>_prior, <target>_host: the posterior of the host) from labelled rows (host, path, target),
    and the global rate."""
    paths = store(rows.where(F.col(target).isNotNull()).groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum((F.col(target) > 0).cast("double")).alias("k")), "quality-paths")
    total = paths.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    rate = ((total["k"] or 0.0) + 1) / ((total["n"] or 0) + 2)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("m", F.lit(rate))
    a = _strength(hosts, "m")
    hosts = hosts.select("host", ((F.col("k") + a * rate) / (F.col("n") + a)).alias("m"))
    joined = store(paths.join(hosts, "host"), "quality-hosts")
    b = _strength(joined, "m")
    return joined.select("host", "path", ((F.col("k") + b * F.col("m")) / (F.col("n") + b)).alias(f"{target}_prior"),
                         F.col("m").alias(f"{target}_host")), rate


def classify(docs: DataFrame, labels: DataFrame, targets: tuple[str, ...] = ("quality", "toxic"), wanted: str = "quality",
             unwanted: str | None = "toxic", least: float = 0.5, host: str = "source", path: str = "lang",
             model: DocumentModel | None = None) -> DataFrame:
    """(doc_id, p_<target> for each target, kept) for each row of ``docs`` (doc_id, text, host, path).

    ``labels`` (doc_id, targets): positive values count as 1; rows with a null label do not count for that target.
    kept: p of ``wanted`` is at least ``least`` and p of ``unwanted`` below it. A target without any label has p 0.5 and
    rejects nothing.

    A null or empty text has no features: its evidence is the model's constant. A null host or path is a value of its
    own; a path without labels takes its host's posterior, a host without labels the global rate. Repeated label rows
    each count; repeated documents are each returned, and those with a null doc_id are scored without labels. Without
    any label every probability is 0.5 and all documents are kept. Other columns are ignored; an empty table gives an
    empty result."""
    targets = list(targets)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col(host), F.lit("")).alias("host"),
                       F.coalesce(F.col(path), F.lit("")).alias("path"))
    model = model or fit(base, labels, targets)
    if model is None:
        return base.select("doc_id", *[F.lit(0.5).alias(f"p_{t}") for t in targets], F.lit(True).alias("kept"))
    scored = store(evidence(base, model, ["doc_id", "host", "path"]), "quality-evidence")
    sites = scored.select("doc_id", "host", "path").where("doc_id is not null").distinct()
    labelled = store(labels.select(F.col("doc_id").cast("long").alias("doc_id"), *targets).join(sites, "doc_id"), "quality-labels")
    out = scored
    for t in targets:
        if t not in model.weights:
            out = out.withColumn(f"p_{t}", F.lit(0.5))
            continue
        prior, rate = posteriors(labelled, t)
        by_host = prior.groupBy("host").agg(F.max(f"{t}_host").alias("h"))  # the same on all paths
        prior = prior.drop(f"{t}_host")
        if prior.count() <= BROADCAST_IDS // 10:  # about 60 bytes a row
            prior, by_host = F.broadcast(prior), F.broadcast(by_host)
        out = out.join(prior, ["host", "path"], "left").join(by_host, "host", "left")
        p = F.coalesce(f"{t}_prior", "h", F.lit(rate))
        odds = F.col(f"e_{t}") + F.log(p / (1 - p)) - F.lit(float(np.log(rate / (1 - rate))))
        out = out.withColumn(f"p_{t}", 1 / (1 + F.exp(-odds))).drop("h", f"{t}_prior")
    kept = F.col(f"p_{wanted}") >= least if wanted in model.weights else F.lit(True)
    if unwanted in model.weights:
        kept = kept & (F.col(f"p_{unwanted}") < least)
    return out.select("doc_id", *[f"p_{t}" for t in targets], kept.alias("kept"))
