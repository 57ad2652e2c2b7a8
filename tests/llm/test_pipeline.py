import hashlib

import corpus_pipeline as cp
import pytest

from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "word", None, "s", 4), (None, "some text", "en", None, 9),
        (4, "same text here", "en", "s", 14), (4, "same text here", "en", "s", 14), (5, "z " * 100_000, "en", "s", 200_000)]


@pytest.fixture(scope="module")
def inputs(spark, sf):
    """The input of each stage and its output, by name."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        after = cp.store(stage(spark, docs, sf), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return sorted(tuple(r) for r in df.select(*cp.COLUMNS).collect())


def test_language_stage_keeps_clean_documents(inputs):
    before, after = inputs["language"]
    assert after.columns == cp.COLUMNS
    lost = {r[0] for r in rows(before)} - {r[0] for r in rows(after)}
    assert len(lost) <= 0.01 * before.count()
    changed = [a for a, b in zip(rows(after), [r for r in rows(before) if r[0] not in lost]) if a != b]
    assert len(changed) <= 0.03 * before.count() and after.where("lang is null").count() == 0


def test_one_document_of_each_group_stays(inputs):
    before, after = inputs["near_duplicates"]
    groups = brute.near_duplicates([(r[0], r[1]) for r in rows(before)], 5, 80)
    assert rows(after) == [r for r in rows(before) if groups[r[0]][1] == r[0]]
    assert after.count() < before.count()


def test_contaminated_documents_go(inputs, spark, sf):
    before, after = inputs["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hit = {d for d, _ in brute.overlaps([(r[0], r[1]) for r in rows(before)], items)}
    assert rows(after) == [r for r in rows(before) if r[0] not in hit] and hit


def test_personal_data_is_masked_and_nothing_else(inputs):
    before, after = inputs["personal_data"]
    old, new = rows(before), rows(after)
    assert [r[0] for r in old] == [r[0] for r in new]
    touched = 0
    for a, b in zip(old, new):
        if brute.personal_data(a[1]):
            touched += 1
            assert not brute.personal_data(b[1]) and b[4] == len(b[1])
        elif a[1] == b[1]:
            assert a == b
    assert touched


def test_mixing_repeats_by_inverted_poisson_counts(inputs):
    from tests.llm.test_text_operators import poisson
    before, after = inputs["mixing"]
    old = rows(before)
    n = {}
    for r in old:
        n[r[3]] = n.get(r[3], 0) + 1
    root = sum(v ** 0.5 for v in n.values())
    got = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    for r in old:
        u = int(hashlib.md5(f"17:1:{r[0]}".encode()).hexdigest()[:13], 16) / 2 ** 52
        assert got.get(r[0], 0) == poisson(u, len(old) * n[r[3]] ** 0.5 / root / n[r[3]])
    assert set(rows(after)) <= set(old)


def test_stages_on_edge_cases_and_empty_tables(spark, sf):
    docs = spark.createDataFrame(EDGE, SCHEMA).selectExpr("*", "1 as kept", "2 as masked", "3 as component_id", "4 as _language")
    want = {"language": {4, 5}, "near_duplicates": {1, 2, 3, 4, 5}, "decontamination": {1, 2, 3, 4, 5},
            "personal_data": {1, 2, 3, 4, 5, None}, "mixing": None}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, sf)
        assert set(out.columns) >= set(cp.COLUMNS)
        ids = [r.doc_id for r in out.collect()]
        if want[name] is not None:
            assert set(ids) - {3} == want[name] - {3}, name
            assert ids.count(4) == (1 if name == "near_duplicates" else 2), name
        assert stage(spark, docs.limit(0), sf).count() == 0, name


def test_run_returns_the_last_stage(spark, sf, inputs):
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "mixing"]
    out = cp.run(spark, sf)
    assert rows(out) == rows(inputs["mixing"][1])
