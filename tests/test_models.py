"""Feature tables and models on the smallest tables: shapes, ranges, error
against the label's spread, grid size."""

import pytest
from pyspark.sql import functions as F

from pairscore.plans import evaluate as EV
from pairscore.plans import features as FE
from pairscore.plans import models as M
from pairscore.plans import pipeline as PL
from pairscore.session import materialize
from pairscore.sources import fixtures as fx


@pytest.fixture(scope="module")
def inputs(spark, sf):
    return PL.Inputs(fx.pairs(spark, sf), fx.descriptions(spark, sf), fx.attributes(spark, sf))


@pytest.fixture(scope="module")
def feats8(inputs):
    f, fitted = FE.build("8", inputs.pairs, inputs.descriptions, inputs.attributes)
    return materialize(f, "test-features8"), fitted


@pytest.mark.parametrize("name,n", [("3", 3), ("6", 6), ("7", 7), ("8", 8)])
def test_feature_sets_shape(inputs, name, n):
    f, fitted = FE.build(name, inputs.pairs, inputs.descriptions, inputs.attributes)
    fs = FE.FEATURE_SETS[name]
    assert list(f.columns[-n:]) == list(fs.features)
    assert set(fitted.models) == set(fs.vector_inputs)
    nulls = f.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in fs.features]).first()
    assert all(v == 0 for v in nulls)


def test_features_8_row_multiplicity(inputs, feats8):
    # one row per pair per brand row (a product with two brand rows counts twice)
    brands = inputs.attributes.where("name = 'MFG Brand Name'").groupBy("product_uid").count()
    expect = (inputs.pairs.join(brands, "product_uid", "left")
              .agg(F.sum(F.coalesce("count", F.lit(1)))).first()[0])
    assert feats8[0].count() == expect


def test_random_forest_range_and_error(feats8):
    f, _ = feats8
    train, test = M.split_by_key(f)
    model = M.fit_pipeline(train, FE.FEATURES_8, M.random_forest(20, 5))
    pred = model.transform(test)
    lo, hi = pred.agg(F.min("prediction"), F.max("prediction")).first()
    ylo, yhi = train.agg(F.min("relevance"), F.max("relevance")).first()
    assert ylo <= lo <= hi <= yhi           # a forest averages training labels
    assert EV.rmse(pred) < EV.label_std(test)
    again = M.fit_pipeline(train, FE.FEATURES_8, M.random_forest(20, 5)).transform(test)
    a = pred.select("id", "prediction").orderBy("id").collect()
    b = again.select("id", "prediction").orderBy("id").collect()
    assert a == b                            # seeded: same model twice


def test_linear_regression_not_worse_than_mean(feats8):
    f, _ = feats8
    train, test = M.split_by_key(f)
    pred = M.fit_pipeline(train, FE.FEATURES_8, M.linear_regression()).transform(test)
    assert EV.rmse(pred) <= EV.label_std(test) * 1.05


def test_cross_validation_grid(feats8):
    f, _ = feats8
    train, _ = M.random_split(f)
    cv = M.cross_validate(train, depths=(2, 3), trees=(3, 5), num_folds=2, parallelism=4)
    assert len(cv.avgMetrics) == 8
    assert all(m > 0 for m in cv.avgMetrics)
    full = M.tuning_grid(M.random_forest(), FE.assembler(FE.FEATURES_8))
    assert len(full) == 12


def test_scoring_with_training_vectors(inputs, feats8):
    _, fitted = feats8
    tr, te = PL.split_inputs(inputs)
    toks = FE.token_table(fitted.feature_set, te.pairs, te.descriptions, te.attributes)
    out = fitted.transform(toks)
    assert "relevance" not in out.columns
    assert out.count() > 0


def test_precomputed_lexical_features_equal_late_ones(inputs, feats8):
    """with_lexical (before materialising) and the feature projection over the
    raw token table give the same word-match and length columns."""
    f, fitted = feats8
    fs = fitted.feature_set
    late = fitted.transform(FE.token_table(fs, inputs.pairs, inputs.descriptions,
                                           inputs.attributes))
    cols = [c for c in fs.features if FE.FEATURE_DEFS[c][0] in ("md", "len")]
    a = sorted(tuple(r) for r in f.select("id", *cols).collect())
    b = sorted(tuple(r) for r in late.select("id", *cols).collect())
    assert a == b and len(a) > 0


@pytest.mark.parametrize("name", ["3", "6"])
def test_description_vectors_per_product_equal_per_pair(inputs, name):
    """Feature sets with a description vector compute it once per product
    and join it; with the same models this equals the per-pair transform."""
    fs = FE.FEATURE_SETS[name]
    feats, fitted = FE.build(fs, inputs.pairs, inputs.descriptions, inputs.attributes)
    per_pair = fitted.transform(FE.token_table(fs, inputs.pairs, inputs.descriptions,
                                               inputs.attributes))
    def rows(df):
        return sorted((r["id"],) + tuple(round(r[c], 9) for c in fs.features)
                      for r in df.collect())
    a, b = rows(feats), rows(per_pair)
    assert len(a) == inputs.pairs.count() and a == b


def test_as_coded_options(inputs):
    """Options that reproduce the original scripts' behaviour: the text 'nan'
    for missing descriptions/attributes, one brand row per product, and
    Word2Vec refitted on the scoring set."""
    fs = FE.feature_set("8", missing_token="nan", dedupe_brand=True)
    feats, fitted = FE.build(fs, inputs.pairs, inputs.descriptions, inputs.attributes)
    assert feats.count() == inputs.pairs.count()          # dedupe: one row per pair
    tr, te = PL.split_inputs(inputs)
    scored = PL.train_and_score(tr, te, fs, M.random_forest(5, 3), refit_vectors_on_score=True)
    assert scored.predictions.count() == te.pairs.count()
    fs3 = FE.feature_set("3", missing_token="nan")
    desc = FE.description_table(fs3, inputs.pairs, inputs.descriptions)
    missing = desc.join(inputs.descriptions, "product_uid", "left_anti")
    toks = {tuple(r[0]) for r in missing.select(FE.TOKEN_COLS["description"]).collect()}
    assert toks == {("nan",)}
    none = FE.description_table(FE.FEATURE_SETS["3"], inputs.pairs, inputs.descriptions) \
        .join(inputs.descriptions, "product_uid", "left_anti")
    assert {tuple(r[0]) for r in none.select(FE.TOKEN_COLS["description"]).collect()} == {()}


def test_prefix_of_a_forest_is_the_forest_of_its_first_trees(feats8):
    """The error of each prefix is that of the mean of these trees, each asked by itself."""
    f, _ = feats8
    rows = FE.assembler(FE.FEATURES_8).transform(f).select("features", "relevance")
    model = M.random_forest(7, 4, seed=3).fit(rows)
    got = M.prefix_errors(model, rows.limit(150), [1, 3, 7])
    sample = rows.limit(150).collect()
    each = [[t.predict(r.features) for t in model.trees] for r in sample]
    for n, rmse in zip((1, 3, 7), got):
        want = (sum((sum(e[:n]) / n - r.relevance) ** 2 for e, r in zip(each, sample)) / len(sample)) ** 0.5
        assert abs(rmse - want) < 1e-9
    assert abs(got[2] - EV.rmse(model.transform(rows.limit(150)))) < 1e-9


def test_nested_grid_shares_fits(feats8, monkeypatch):
    f, _ = feats8
    train, _ = M.random_split(f)
    fits = []
    one = M.RandomForestRegressor._fit
    monkeypatch.setattr(M.RandomForestRegressor, "_fit", lambda self, df: fits.append(self.getNumTrees()) or one(self, df))
    cv = M.cross_validate(train, depths=(2, 3), trees=(6, 3), num_folds=2, parallelism=2, nested=True)
    assert len(cv.avgMetrics) == len(cv.getEstimatorParamMaps()) == 8
    assert len(fits) == 2 * 2 * 2 + 1 and fits.count(6) >= 8
    best = min(cv.avgMetrics)
    rf = cv.getEstimator().getStages()[1]
    chosen = cv.getEstimatorParamMaps()[cv.avgMetrics.index(best)]
    assert cv.bestModel.stages[1].getNumTrees == chosen[rf.numTrees]
    apart = M.cross_validate(train, depths=(2, 3), trees=(6, 3), num_folds=2, parallelism=2)
    assert max(abs(a - b) for a, b in zip(cv.avgMetrics, apart.avgMetrics)) < 0.1
