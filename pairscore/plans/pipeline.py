"""End-to-end relevance jobs: features -> model -> scored pairs.

``train_and_score`` is the scripted pipeline: fit Word2Vec on the training
pairs, build features for both sides, fit the estimator on the training
features and score the other side. ``tune`` is the grid search: split the
feature table, cross-validate the grid on the training part, score the
hold-out part with the best model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ..session import materialize
from . import features as FE
from . import models as M


@dataclass
class Inputs:
    pairs: DataFrame
    descriptions: DataFrame
    attributes: DataFrame


@dataclass
class Scored:
    model: PipelineModel
    predictions: DataFrame          # id, product_uid, relevance?, features..., prediction
    train_features: DataFrame
    fitted: FE.FittedFeatures


def train_and_score(train: Inputs, test: Inputs, feature_set: str | FE.FeatureSet = "8",
                    estimator=None, refit_vectors_on_score: bool = False) -> Scored:
    fs = FE.FEATURE_SETS[feature_set] if isinstance(feature_set, str) else feature_set
    est = estimator if estimator is not None else M.random_forest(200, 10)
    tr, fitted = FE.build(fs, train.pairs, train.descriptions, train.attributes)
    tr = materialize(tr, f"features{fs.name}")
    te_tt = FE.prepare(fs, test.pairs, test.descriptions, test.attributes, checkpoint=False)
    te = fitted.transform(te_tt.pairs, refit=refit_vectors_on_score, products=te_tt.products)
    model = M.fit_pipeline(tr, fs.features, est)
    return Scored(model, model.transform(te), tr, fitted)


def split_inputs(inputs: Inputs, key: str = "product_uid") -> tuple[Inputs, Inputs]:
    """Hold-out by product: the product tables are shared, the pairs split."""
    a, b = M.split_by_key(inputs.pairs, key)
    return (Inputs(a, inputs.descriptions, inputs.attributes),
            Inputs(b.drop("relevance"), inputs.descriptions, inputs.attributes))


@dataclass
class Tuned:
    cv_model: object
    predictions: DataFrame
    holdout: DataFrame


def tune(inputs: Inputs, train_fraction: float = 0.7, split_seed: int = 7, **cv_args) -> Tuned:
    """Features of all pairs -> random 70/30 split -> CV on the 70 % ->
    best model scores the 30 %. Forests of one depth and feature list share
    their fits (``models.cross_validate``) unless ``nested=False``."""
    feats, _ = FE.build("8", inputs.pairs, inputs.descriptions, inputs.attributes)
    feats = materialize(feats, "features8cv")
    train, holdout = M.random_split(feats, train_fraction, split_seed)
    cv_model = M.cross_validate(train, **{"nested": True} | cv_args)
    return Tuned(cv_model, cv_model.transform(holdout), holdout)
