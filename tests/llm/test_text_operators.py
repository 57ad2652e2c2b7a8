import itertools
import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from pairscore.llm import decontaminate, language, mixing, pii, quality, urlfilter
from tests.llm import brute

EDGE = [(1, None, None, None), (2, "", "en", "h"), (3, "word", None, "h"), (None, "some text", "en", None),
        (4, "same", "en", "h"), (4, "same", "en", "h"), (5, "z " * 100_000, "en", "h")]


def edge(spark):
    return spark.createDataFrame(EDGE, "doc_id long, text string, lang string, source string").selectExpr(
        "*", "1 as replica", "2 as tokens", "3 as key", "4 as host", "5 as masked", "6 as n")


# ---- mixing

def poisson(u, rate):
    p, total, k = math.exp(-rate), math.exp(-rate), 0
    while total <= u:
        k += 1
        p *= rate / k
        total += p
    return k


def test_counts_are_inverted_poisson_draws(spark):
    import hashlib
    docs = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 9)) as source")
    got = {r.doc_id: r["count"] for r in mixing.replicate(docs).groupBy("doc_id").count().collect()}
    rows = [(r.doc_id, r.source) for r in docs.collect()]
    n = {s: sum(x == s for _, x in rows) for s in {s for _, s in rows}}
    root = sum(math.sqrt(v) for v in n.values())
    for d, s in rows:
        u = int(hashlib.md5(f"17:1:{d}".encode()).hexdigest()[:13], 16) / 2 ** 52
        assert got.get(d, 0) == poisson(u, len(rows) * math.sqrt(n[s]) / root / n[s])


def test_weights_large_rates_and_salted_join(spark, monkeypatch):
    docs = spark.range(300).selectExpr("id as doc_id", "if(id < 200, 'a', if(id < 290, 'b', null)) as source")
    weights = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 1.0), ("c", 4.0), (None, -3.0)], "source string, weight double")
    plain = mixing.replicate(docs, weights, total=60_000)
    by = {r.source: r["count"] for r in plain.groupBy("source").count().collect()}
    assert set(by) == {"a", "b"} and abs(by["a"] - 15_000) < 600 and abs(by["b"] - 45_000) < 1100
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    again = mixing.replicate(docs, weights, total=60_000)
    assert again.exceptAll(plain).count() == 0 and again.count() == plain.count()


def test_shuffle_is_global_and_sorted_in_partitions(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "'s' as source")
    rows = mixing.replicate(docs).selectExpr("spark_partition_id() as p", "doc_id", "shuffle_key").collect()
    for _, part in itertools.groupby(rows, lambda r: r.p):
        keys = [r.shuffle_key for r in part]
        assert keys == sorted(keys)
    ids = [r.doc_id for r in rows]
    assert abs(np.corrcoef(ids, np.arange(len(ids)))[0, 1]) < 0.1


def test_mixing_edge_cases(spark):
    out = mixing.replicate(edge(spark), total=70)
    assert out.columns == ["doc_id", "text", "lang", "source", "tokens", "key", "host", "masked", "n", "replica", "shuffle_key"]
    same = [r["count"] for r in out.where("doc_id = 4").groupBy("replica").count().collect()]
    assert set(same) <= {2}
    assert mixing.replicate(edge(spark).limit(0)).count() == 0


# ---- decontamination

@pytest.mark.parametrize("seed", range(3))
def test_overlaps_match_all_alignments(spark, seed):
    rng = random.Random(seed)
    word = lambda: f"w{int(60 * rng.random() ** 2)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 5, 7, 9, 12, 20, 40])))) for i in range(25)]
    docs = []
    for d in range(120):
        words = [word() for _ in range(rng.randrange(0, 80))]
        if rng.random() < 0.5:
            cut = rng.choice(items)[1].split()
            lo = rng.randrange(len(cut))
            cut = cut[lo: lo + rng.randrange(8, 30)]
            for _ in range(rng.randrange(0, 4)):
                cut[rng.randrange(len(cut))] = "zz"
            at = rng.randrange(len(words) + 1)
            words[at:at] = cut
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(words).upper()))
    got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string"))
    want = brute.overlaps(docs, items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and want


def test_masks_see_every_pair_of_substitutions():
    for hit in itertools.combinations(range(12), 2):
        assert any(not set(hit) & {p + o for o in m} for m in decontaminate.MASKS for p in range(12 - m[-1]))


def test_masks_see_every_allowed_substitution_in_short_items():
    """Every length from 5 to 12 and every place: some seed of the item leaves the place out and lies within the item."""
    for n in range(5, 13):
        masks = list(decontaminate.MASKS) + ([m for _, m in decontaminate.short_masks(n)] if n < decontaminate.SPAN else [])
        for hit in itertools.combinations(range(n), n // 6):
            assert any(not set(hit) & {p + o for o in m} for m in masks for p in range(n - m[-1])), (n, hit)
    numbers = [number for n in range(5, 9) for number, _ in decontaminate.short_masks(n)]
    assert len(set(numbers)) == len(numbers) and min(numbers) >= len(decontaminate.MASKS)


def test_planted_substitutions_in_short_items(spark):
    items = [(n, " ".join(f"item{n}x{j}" for j in range(n))) for n in range(5, 13)]
    docs = []
    for n, text in items:
        for j in range(n):
            words = text.split()
            words[j] = "other"
            docs.append((100 * n + j, " ".join(["before", *words, "after"])))
        docs.append((100 * n + 50, f"x {text}"))
    got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute.overlaps(docs, items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) == sum(range(6, 13)) + 8


def test_decontamination_edge_cases(spark):
    items = spark.createDataFrame([(1, "z " * 30), (1, "z " * 30), (2, None), (None, "same " * 9), (3, "")], "item_id long, text string")
    rows = decontaminate.decontaminate(edge(spark), items).collect()
    assert len(rows) == len(EDGE)
    assert {r.doc_id: (r.item_ids, r.kept) for r in rows if not r.kept} == {5: ([1], False)}
    assert decontaminate.decontaminate(edge(spark), items.limit(0)).where("kept").count() == len(EDGE)
    assert decontaminate.decontaminate(edge(spark).limit(0), items).count() == 0


# ---- url lists

def test_very_long_urls(spark):
    import time
    entries = spark.createDataFrame([("l", "b.com/x/", "add", "2024-01-01"), ("l", "c.com", "add", "2024-01-01"), ("m", "b.com/x/x/x/", "add", "2024-01-01")],
                                    "list_name string, pattern string, action string, day string")
    rows = [(1, "http://b.com" + "/x" * 500_000, "2024-02-01"), (2, "http://" + "a." * 300_000 + "c.com/", "2024-02-01"),
            (3, "http://b.com/x?" + "/x" * 500_000, "2024-02-01"), (4, "http://b.com/x/x/" + "y" * 1_000_000, "2024-02-01")]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched string")
    began = time.time()
    got = {r.page_id: (r.lists, r.n_entries) for r in urlfilter.judge(captures, entries).select("page_id", "lists", "n_entries").collect()}
    assert got == {1: ("l,m", 2), 2: ("l", 1), 3: ("", 0), 4: ("l", 1)}
    assert time.time() - began < 60


def test_entries_hold_between_their_days(spark):
    entries = spark.createDataFrame([
        ("l", "b.com", "add", "2024-02-10"), ("l", "b.com", "remove", "2024-05-01"), ("l", "b.com", "add", "2024-04-01"),
        ("m", "x.a.com/p/", "add", "2024-01-01"), ("m", "a.com", "add", "2024-03-01"), ("m", "a.com", "remove", "2024-03-01"),
        ("m", None, "add", "2024-01-01"), ("m", "c.com", "other", "2024-01-01"), ("n", "b.com", "add", "2023-01-01")],
        "list_name string, pattern string, action string, day string")
    rows = [(1, "http://b.com/", "2024-02-09"), (2, "https://www.B.com:8080/q?x", "2024-02-10"), (3, "http://b.com", "2024-04-30"),
            (4, "http://b.com", "2024-05-01"), (5, "http://x.a.com/p/q", "2024-01-01"), (6, "http://x.a.com/pq", "2024-03-01"),
            (7, "http://xb.com/", "2024-03-01"), (8, None, "2024-03-01"), (9, "ftp://b.com/", "2024-03-01"),
            (10, "http://b.com/", None), (None, "http://u:p@sub.b.com./", "2024-03-01"), (1, "http://b.com/", "2024-02-09")]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched string").selectExpr("*", "1 as host", "2 as pattern")
    got = urlfilter.judge(captures, entries).collect()
    assert len(got) == len(rows)
    assert {r.page_id: (r.lists, r.n_entries, r.kept) for r in got} == {
        1: ("n", 1, False), 2: ("l,n", 2, False), 3: ("l,n", 2, False), 4: ("n", 1, False), 5: ("m", 1, False),
        6: ("", 0, True), 7: ("", 0, True), 8: ("", 0, True), 9: ("", 0, True), 10: ("", 0, True), None: ("l,n", 2, False)}
    assert urlfilter.judge(captures.limit(0), entries).count() == 0
    assert urlfilter.judge(captures, entries.limit(0)).where("kept").count() == len(rows)


# ---- language and quality

def test_language_of_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    known = docs.where("doc_id % 2 = 0")
    model = language.fit_text_model(known.selectExpr("doc_id as key", "text", "lang as label"), "key", "text", "label")
    held = docs.where("doc_id % 2 = 1").withColumnRenamed("lang", "truth").selectExpr("*", "cast(null as string) as lang")
    rows = language.identify(held, model=model).join(held.select("doc_id", "truth"), "doc_id").collect()
    assert sum(r.language == r.truth for r in rows) >= 0.97 * len(rows)


def test_declared_language_and_host_decide_short_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "lang as source".split(" ")[0])
    docs = docs.selectExpr("doc_id", "text", "lang", "lang as source")
    short = spark.createDataFrame([(10 ** 9, "a", "de", "de"), (10 ** 9 + 1, "a", "fr", "fr")], docs.schema)
    got = {r.doc_id: r.language for r in language.identify(docs.unionByName(short)).where(f"doc_id >= {10 ** 9}").collect()}
    assert got == {10 ** 9: "de", 10 ** 9 + 1: "fr"}


def test_rare_and_many_languages_are_known(spark):
    rng = random.Random(4)
    words = {x: ["".join(rng.choice(letters) for _ in range(5)) for _ in range(40)] for x, letters in
             [("en", "abcdefg"), ("xx", "mnopq"), ("yy", "rstuvwz")]}
    text = lambda x: " ".join(rng.choice(words[x]) for _ in range(30))
    rows = [(i, text("en"), "en", "h") for i in range(9000)] + [(i, text("xx"), "xx", "h") for i in (9000, 9001)]
    rows += [(9002 + i, text("yy"), "yy", "g") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.language for r in language.identify(df).where("doc_id >= 8990").collect()}
    assert got == {i: x for i, _, x, _ in rows if i >= 8990}
    many = [(i, f"{chr(0x4e00 + i)} {chr(0x4e00 + i)}", f"l{i:03}", "h") for i in range(230)]
    model = language.fit_text_model(spark.createDataFrame(many, df.schema), "doc_id", "text", "lang")
    assert model.languages == sorted(x for _, _, x, _ in many)


def _phrases(seed=6):
    rng = random.Random(seed)
    words = {x: ["".join(rng.choice(letters) for _ in range(5)) for _ in range(40)] for x, letters in
             [("en", "abcdefg"), ("de", "mnopq"), ("fr", "rstuvwz")]}
    return rng, lambda x, n=12: " ".join(rng.choice(words[x]) for _ in range(n))


def test_declared_tags_are_compared_by_primary_subtag(spark):
    _, text = _phrases()
    rows = [(i, text("en"), x, "h") for i, x in enumerate(["EN", "en", "en-US", " En_gb "] * 20)] + [(100 + i, text("de"), "de", "h") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.language, r.declared) for r in language.identify(df).collect()}
    assert got == {i: (x.strip()[:2].lower(), x) for i, _, x, _ in rows}


def test_junk_declarations_are_one_class(spark):
    _, text = _phrases()
    rows = [(i, text("en"), "en", "h") for i in range(300)] + [(1000 + i, text("de"), "de", "h") for i in range(300)]
    rows += [(10_000 + i, text("fr"), f"junk{i}", "h") for i in range(20_000)] + [(900_000, text("fr"), "en", "h"), (900_001, text("en"), "junk7", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language.fit_text_model(df.selectExpr("doc_id", "text", "lang"), "doc_id", "text", "lang")
    assert len(model.languages) == language.MOST_LANGUAGES + 1 and {"en", "de", language.REST} < set(model.languages)
    monkey = language.MOST_LANGUAGES
    language.MOST_LANGUAGES = 2
    try:
        got = {r.doc_id: r.language for r in language.identify(df).collect()}
    finally:
        language.MOST_LANGUAGES = monkey
    assert all(got[i] == x for i, _, x, _ in rows if i < 900_000)      # rare tags keep what they declare
    assert got[900_001] == "en" and got[900_000] in ("en", language.UNKNOWN)


def test_fusion_equals_the_posterior_by_hand(spark):
    rng, text = _phrases()
    rows = []
    for i in range(240):
        x = rng.choice(["en", "de", "fr"])
        said = rng.choice([x, x, x.upper(), "en", None, "q1", "q2"])
        host = rng.choice(["a.site.org", "b.site.org", "c.net", "", None, f"{x}.home.de"])
        rows.append((i, rng.choice([text(x, n) for n in (1, 2, 8)] + ["", None, "123 456"]), said, host, None if host is None else host.rpartition(".")[2]))
    rows += [rows[0], (None, text("fr"), "fr", "c.net", "net")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, tld string")
    labelled = df.selectExpr("doc_id as key", "text", "nullif(lower(lang), '') as label")
    model = language.fit_text_model(labelled, "key", "text", "label")
    names = model.languages
    ll = language.text_scores(df.selectExpr("doc_id as key", "text", "lang", "source", "tld"), model, "text", ["key", "lang", "source", "tld"]).collect()
    seen = [dict(ll=r.ll, letters=r.letters, said=(r.lang or "").lower(), host=r.source or "", suffix=r.tld or "", key=r.key,
                 guess=int(np.argmax(r.ll)) if r.letters else None) for r in ll]

    def count(**at):
        own = [s["guess"] for s in seen if s["guess"] is not None and all(s[k] == v for k, v in at.items())]
        return np.array([own.count(i) for i in range(len(names))], float)
    total = count()
    overall = (total + 1) / (total.sum() + len(names))
    shrunk = lambda n, prior: (n + language.PSEUDO * prior) / (n.sum() + language.PSEUDO)
    want = {}
    for s in seen:
        if not s["letters"]:
            continue
        site = ".".join(s["host"].split(".")[-2:])
        of_site = shrunk(sum(count(host=h) for h in {x["host"] for x in seen} if ".".join(h.split(".")[-2:]) == site), overall)
        prior = shrunk(count(host=s["host"]), overall if site == s["host"] else of_site)
        log = np.array(s["ll"]) + np.log(prior)
        for factor in ("said", "suffix"):
            log += np.log((count(**{factor: s[factor]}) + 0.5) / (total + 0.5 * len({x[factor] for x in seen})))
        p = np.exp(log - log.max())
        want.setdefault(s["key"], set()).add((names[int(log.argmax())], round(float(p.max() / p.sum()), 9)))
    got = {}
    for r in language.identify(df, suffix=F.col("tld")).where("letters > 0").collect():
        got.setdefault(r.doc_id, set()).add((r.language, round(r.probability, 9)))
    assert got == want and len(want) > 100


def test_page_text_and_language(spark):
    pages = ["<p>a</p>b", "x<script src='a>b'>var a = '<b>';</script>y<STYLE>p {}</style >z", "1 < 2 and <b>3", "<script>never closed <b>x", None, "",
             "<html\nclass=a lang='EN-us'><body>t", '<HTML lang=de>', "<html><p lang=fr>", "no html", "<scripted>kept</scripted>"]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = {r.i: (r.t, r.n) for r in df.select("i", language.page_text(F.col("html")).alias("t"), language.page_language(F.col("html")).alias("n")).collect()}
    words = {i: None if t is None else t.split() for i, (t, _) in got.items()}
    assert words == {0: ["a", "b"], 1: ["x", "y", "z"], 2: ["1", "2", "and", "3"], 3: [], 4: None, 5: [], 6: ["t"], 7: [], 8: [], 9: ["no", "html"],
                     10: ["kept"]}
    assert [got[i][1] for i in (6, 7, 8, 9, 4)] == ["EN", "de", None, None, None]


def test_long_pages_are_linear(spark):
    import time
    n = 1 << 20
    pages = ["<" * n, "<script " * (n // 8), "<html " * (n // 6), "<html" + " lang" * (n // 5), "</style" * (n // 7), "<a>b" * (n // 4), " " * n]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string").repartition(len(pages))
    began = time.time()
    got = df.select("i", F.length(language.page_text(F.col("html"))), language.page_language(F.col("html"))).collect()
    assert len(got) == len(pages) and time.time() - began < 60


def test_page_language_query(spark, sf):
    from pairscore.llm import queries
    rows = queries.page_language_fusion(spark, sf).collect()
    pages = spark.read.parquet(f"{sf}/pages.parquet").count()
    assert len(rows) == pages and all(0 <= r.probability <= 1 + 1e-9 for r in rows)
    kept = [r for r in rows if r.kept and r.declared]
    assert kept and sum(r.language == r.declared.lower() for r in kept) >= 0.9 * len(kept)


def test_sample_takes_the_smallest_hashes_of_each_label(spark):
    df = spark.range(3000).selectExpr("if(id % 100 = 0, 'b', 'a') as label", "id as k")
    got = {(r.label, r.k) for r in language._sample(df.union(df), 20, {"a": 5940, "b": 60}).collect()}
    hashed = df.selectExpr("label", "k", "shiftrightunsigned(xxhash64(k), 11) as h").collect()
    assert got == {(x, k) for x in "ab" for _, k in sorted((r.h, r.k) for r in hashed if r.label == x)[:20]}


def test_language_edge_cases(spark):
    rows = language.identify(edge(spark)).collect()
    assert len(rows) == len(EDGE)
    assert {(r.doc_id, r.language) for r in rows if not r.letters} == {(1, None), (2, None)}
    assert all(not r.kept for r in rows if not r.letters)
    assert language.identify(edge(spark).limit(0)).count() == 0
    assert language.identify(edge(spark).selectExpr("doc_id", "text", "cast(null as string) lang", "source")).where("kept").count() == 0


def test_quality_of_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.where("doc_id is not null").dropDuplicates(["doc_id"])
    known = labels.where("pmod(hash(doc_id), 3) > 0")
    rows = quality.classify(docs, known).join(labels.join(known, "doc_id", "left_anti"), "doc_id").collect()
    assert len(rows) > 80
    assert sum((r.p_quality >= 0.5) == (r.quality > 0) for r in rows) >= 0.9 * len(rows)
    assert sum((r.p_toxic >= 0.5) == (r.toxic > 0) for r in rows) >= 0.9 * len(rows)


def test_sparse_sites_shrink_to_the_rate_above(spark):
    rows = [("a", "p", 1)] * 300 + [("a", "q", 1)] * 1 + [("b", "p", 0)] * 150 + [("b", "p", 1)] * 150 + [("c", "p", 0)]
    prior, rate = quality.posteriors(spark.createDataFrame(rows, "host string, path string, y int"), "y")
    p = {(r.host, r.path): r.y_prior for r in prior.collect()}
    assert p["a", "p"] > 0.95 and 0.45 < p["b", "p"] < 0.6 and 0.2 < p["c", "p"] < rate and p["a", "q"] > rate


def test_posteriors_and_probabilities_by_hand(spark):
    """Every level of the priors, and every probability, recomputed from the labels in plain Python."""
    rng = random.Random(12)
    docs = [(i, rng.choice(["fine text here", "bad text here", "", None, "plain words"]), rng.choice(["en", "de", None]),
             rng.choice(["a", "a", "a", "b", "c", f"h{rng.randrange(9)}", None])) for i in range(400)]
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 0, 1])) for i in rng.sample(range(420), 250)]
    marks += [marks[0], (None, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = quality.fit(df, labels, ["quality", "toxic"])
    odds = {r.doc_id: r for r in quality.evidence(df, model, ["doc_id"]).collect()}
    place = {d: (host or "", path or "") for d, _, path, host in docs}
    rows = {r.doc_id: r for r in quality.classify(df, labels, model=model).collect()}

    def strength(groups):     # (n, k, rate above)
        n, g = sum(x for x, _, _ in groups), len(groups)
        var = sum(x * m * (1 - m) for x, _, m in groups)
        if g < 2 or not var:
            return 100.0
        v = var / n
        spread = (sum(x * (k / x - m) ** 2 for x, k, m in groups) - (g - 1) * v) / (n - sum(x * x for x, _, _ in groups) / n)
        return min(1e4, max(2.0, v / spread - 1)) if spread > 0 else 1e4
    for t, at in (("quality", 1), ("toxic", 2)):
        own = [(place[m[0]], m[at] > 0) for m in marks if m[0] in place and m[at] is not None]
        rate = (sum(y for _, y in own) + 1) / (len(own) + 2)
        tally = lambda key: {x: (sum(key(p) == x for p, _ in own), sum(y for p, y in own if key(p) == x)) for x in {key(p) for p, _ in own}}
        hosts, paths = tally(lambda p: p[0]), tally(lambda p: p)
        a = strength([(n, k, rate) for n, k in hosts.values()])
        of_host = {h: (k + a * rate) / (n + a) for h, (n, k) in hosts.items()}
        b = strength([(n, k, of_host[p[0]]) for p, (n, k) in paths.items()])
        of_path = {p: (k + b * of_host[p[0]]) / (n + b) for p, (n, k) in paths.items()}
        for d, p in place.items():
            prior = of_path.get(p, of_host.get(p[0], rate))
            z = odds[d][f"e_{t}"] + math.log(prior / (1 - prior)) - math.log(rate / (1 - rate))
            assert abs(rows[d][f"p_{t}"] - 1 / (1 + math.exp(-z))) < 1e-9, (t, d)
    assert all(r.kept == (r.p_quality >= 0.5 and r.p_toxic < 0.5) for r in rows.values())


def test_targets_are_fitted_on_their_own_labels(spark):
    rng = random.Random(6)
    say = lambda *own: " ".join([*own, *(f"w{rng.randrange(30)}" for _ in range(10))])
    docs = [(i, say("good" if i % 2 else "poor", "vile" if i % 4 < 2 else "kind"), "en", "h") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    truth = {i: (i % 2, int(i % 4 < 2)) for i, *_ in docs}
    labels = spark.createDataFrame([(i, q if i % 3 else None, None if i % 3 else t) for i, (q, t) in truth.items()],
                                   "doc_id long, quality int, toxic int")
    rows = quality.classify(df, labels).collect()
    assert all((r.p_quality >= 0.5, r.p_toxic >= 0.5) == (bool(truth[r.doc_id][0]), bool(truth[r.doc_id][1])) for r in rows)
    assert all(r.kept == (truth[r.doc_id] == (1, 0)) for r in rows)
    rows = quality.classify(df, labels.selectExpr("doc_id", "quality", "cast(null as int) as toxic")).collect()
    assert all(r.p_toxic == 0.5 and r.kept == (r.p_quality >= 0.5) == bool(truth[r.doc_id][0]) for r in rows)


def test_paths_without_labels_take_their_hosts_posterior(spark):
    rows = [("a", "p", 1)] * 1000 + [("a", f"q{i}", 0) for i in range(5)] + [("b", "p", 0)] * 900 + [("c", "p", 1)] * 20
    docs = [(i, "x", path, host) for i, (host, path, _) in enumerate(rows)] + [(5000, "x", "new", "a")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, y) for i, (_, _, y) in enumerate(rows)], "doc_id long, quality int")
    model = quality.DocumentModel(np.zeros(0, np.int64), {"quality": np.zeros(1, np.float32)})
    got = quality.classify(df, labels, ("quality",), unwanted=None, model=model).where("doc_id = 5000").first()
    prior, rate = quality.posteriors(spark.createDataFrame(rows, "host string, path string, y int"), "y")
    host = {r.y_host for r in prior.where("host = 'a'").collect()}
    assert len(host) == 1 and min(host) > 0.98
    p = min(host)
    odds = p / (1 - p) * (1 - rate) / rate
    assert got.p_quality == pytest.approx(odds / (1 + odds), rel=1e-6)


def test_telling_words_of_a_long_tail_count(spark):
    rng = random.Random(7)
    say = lambda i: f"{'bad' if i % 2 else 'fine'}{'abcdefghijklmnopqrst'[i // 2 % 20]}{'abcdefghijklmnopqrst'[i // 40 % 20]}"
    docs = [(i, " ".join([say(i), *(f"w{rng.randrange(30)}" for _ in range(8))]), "en", "h") for i in range(9600)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i, *_ in docs], "doc_id long, toxic int")
    assert len(quality.fit(df, labels, ["toxic"]).features) >= 750
    rows = quality.classify(df, labels, ("toxic",), wanted="toxic", unwanted=None).collect()
    assert sum((r.p_toxic >= 0.5) == bool(r.doc_id % 2) for r in rows) >= 0.98 * len(rows)


def test_quality_edge_cases(spark):
    labels = spark.createDataFrame([(2, 1, 0), (4, 0, 1), (4, 0, 1), (5, None, 1), (None, 1, 1), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    assert quality.classify(edge(spark), labels).count() == len(EDGE)
    assert quality.classify(edge(spark).limit(0), labels).count() == 0
    rows = quality.classify(edge(spark), labels.limit(0)).collect()
    assert len(rows) == len(EDGE) and all(r.kept and r.p_quality == 0.5 for r in rows)


# ---- personal data

def test_base_spans_follow_the_patterns():
    rng = random.Random(8)
    bits = ["a.b@c.de", "@", "1.2.3.4", "1.2.3.4.5", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485",
            "+", "-", " ", ".", "x", "é", "0012.3.4.5", "5500005555555559", "+4912345678", "a@b", "@x.y", "\n", "12", "+-1", "..", "z@q.w@r.t"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(0, 14)))
        assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)] == brute.personal_data(text), text


def test_long_runs_take_linear_time():
    import time
    for text in ("1" * 400_000, "a" * 400_000 + "@", "1." * 200_000, "+1" + " " * 400_000, "@" * 200_000, "a@" * 100_000):
        t = time.time()
        pii.base_spans(text)
        assert time.time() - t < 3


def corpus(n, seed):
    rng = random.Random(seed)
    digits = lambda k: "".join(str(rng.randrange(10)) for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(2, 8)))

    def card():
        body = "4" + digits(14)
        return next(body + c for c in "0123456789" if pii.luhn(body + c))
    kinds = [lambda: f"{word()}.{digits(2)}@mail{digits(1)}.example.com", lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
             card, lambda: f"+1 ({digits(3)}) 555-{digits(4)}", word]
    return [(i, " ".join([word() for _ in range(rng.randrange(5, 20))] + [rng.choice(kinds)()] + [word() for _ in range(12)]
                         + [rng.choice(kinds)()] + [word() for _ in range(9)])) for i in range(n)]


@pytest.fixture(scope="module")
def tagger():
    x, y = pii.training_windows([(t, pii.base_spans(t)) for _, t in corpus(300, 1)])
    return pii.train(x, y)


def test_tagger_finds_held_out_spans(tagger):
    texts = [t for _, t in corpus(150, 2)]
    want = {(i, *s) for i, t in enumerate(texts) for s in pii.base_spans(t)}
    got = {(i, *s) for i, f in enumerate(pii.model_spans(tagger, texts)) for s in f}
    assert len(want & got) >= 0.85 * len(want) and len(want & got) >= 0.85 * len(got)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 128, (7, 3)), np.array([[0, 1, 3], [0, 2, 4], [1, 2, 0], [2, 0, 5], [0, 0, 6], [0, 7, 6], [1, 8, 0]])
    tagger = pii.train(np.zeros((4, 7), np.int16), np.zeros((4, 7), np.int64), hidden=4, steps=1, batch=2)
    tagger.params = {k: rng.normal(0, 0.5, v.shape) for k, v in tagger.params.items()}
    _, g = pii.gradients(tagger, x, y)
    for name in tagger.params:
        flat = tagger.params[name].reshape(-1)
        for at in rng.integers(0, flat.size, 6):
            old, sides = flat[at], []
            for d in (1e-3, -1e-3):
                flat[at] = old + d
                sides.append(pii.gradients(tagger, x, y)[0])
            flat[at] = old
            assert abs((sides[0] - sides[1]) / 2e-3 - g[name].reshape(-1)[at]) < 2e-3, name


def test_windows_without_hints_change_nothing(tagger):
    texts = [t * 3 for _, t in corpus(30, 5)] + ["no such thing here " * 40, ""]
    same = [pii.reconcile(t, pii.base_spans(t), f) for t, f in zip(texts, pii.model_spans(tagger, texts, gate=True))]
    full = [pii.reconcile(t, pii.base_spans(t), f) for t, f in zip(texts, pii.model_spans(tagger, texts, gate=False))]
    assert same == full


def letter_mails(n, seed, at=None):
    """(text, start, end of its e-mail): names and domains of letters only."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(2, 8)))
    out = []
    for _ in range(n):
        mail = f"{word()}.{word()}{rng.choice(at or ['@'])}{word()}.{rng.choice(['com', 'org', 'net'])}"
        before = " ".join(word() for _ in range(rng.randrange(5, 30))) + " "
        out.append((before + mail + " " + " ".join(word() for _ in range(20)), len(before), len(before) + len(mail)))
    return out


@pytest.fixture(scope="module")
def letter_tagger():
    texts = [t for t, _, _ in letter_mails(400, 11)] + [t for _, t in corpus(100, 1)]
    return pii.train(*pii.training_windows([(t, pii.base_spans(t)) for t in texts]))


def test_spelt_out_mails_of_letters_are_found(spark, letter_tagger):
    held = letter_mails(80, 12, [" at ", " (at) ", "[at]"])
    texts = [t for t, _, _ in held]
    assert not any(c.isdigit() or c == "@" for t in texts for c in t)
    found = [pii.reconcile(t, [], f) for t, f in zip(texts, pii.model_spans(letter_tagger, texts))]
    assert found == [pii.reconcile(t, [], f) for t, f in zip(texts, pii.model_spans(letter_tagger, texts, gate=False))]
    assert sum((0, s, e) in f for (_, s, e), f in zip(held, found)) >= 0.7 * len(held)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.detect(df, letter_tagger, mask=True).collect()}
    assert [rows[i].spans for i in range(len(texts))] == [pii.named(f) for f in found]
    assert all(("<EMAIL>" in rows[i].masked) == bool(f) for i, f in enumerate(found))


def test_gate_is_open_for_every_possible_mail():
    class Held(Exception):
        pass

    class Tagger:
        def decode(self, x):
            raise Held
    for mail in ("jane.doe at example.com", "info [at] firm.org", "a AT b.c", "x(at)y-z.co.uk", "%at-.-", "noatsign.here", "q (at) \u212a.\u017f"):
        assert pii.possible(0, mail)
        for text in (mail, "z " * 200 + mail + " z" * 200):
            with pytest.raises(Held):
                pii.model_spans(Tagger(), [text])
    for text in ("look at that", "at the end. Then", "file.name that"):
        assert pii.model_spans(Tagger(), [text]) == [[]]


def test_personal_data_edge_cases(spark, tagger):
    import hashlib
    df = edge(spark)
    rows = pii.detect(df, mask=True).collect()
    assert len(rows) == len(EDGE) and all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert pii.detect(df.limit(0)).count() == 0
    text = "é me@a.bc, 4111 1111 1111 1111 +1 (988) 555-2485 1.2.3.4 é" + " q" * 70_000 + " 8.8.8.8"
    df = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    rows = pii.detect(df, tagger, mask=True).collect()
    base = brute.personal_data(text)
    assert len(rows) == 3 and all((r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 2, 1, 1) for r in rows)
    assert rows[0].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
    assert set(f"{k}:{s}:{e}" for k, s, e in base) <= set(rows[0].spans.split(","))
    assert rows[0].masked.startswith("é <EMAIL>, <CARD>") and rows[0].masked.endswith("<IP>") and "@" not in rows[0].masked
