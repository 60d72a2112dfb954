"""Classifiers on the feature table: preprocessing, ensembles, calibration, validation.

All fitting is Spark ML: the driver loops over models and folds, the executors
hold the rows. Every fitted thing here has ``score(df) -> df + probability``.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linksift.config import JobConfig
from linksift.constants import CONTINUOUS_FEATURES, FEATURES, PASSTHROUGH_FEATURES
from linksift.operators.evaluate import binary_metrics
from linksift.operators.flat import FlatModel, dense, flat_forest, matrix
from linksift.operators.ngrams import CharNGramHasher
from linksift.operators.parse import require_features
from linksift.operators.splits import hash_order, stratified_folds
from linksift.session import shared_folder, written

#: Rows whose vectors a task holds while a model is fitted on them.
ROWS_A_TASK = 50_000
#: Fixed value: the published gain in loss below which boosting stops; the library's own 0.01 ends it far sooner.
BOOSTING_TOL = 1e-7
RANDOM_CUTS = 31  # random cut points per feature for the extra-trees stand-in


def vector_names(cfg: JobConfig) -> list[str]:
    """Names of the slots of the assembled vector."""
    grams = [f"ng_{i}" for i in range(cfg.ngram_dim)] if cfg.use_ngram_embeddings else []
    return [*CONTINUOUS_FEATURES, *PASSTHROUGH_FEATURES, *grams]


def prepared(df: DataFrame) -> DataFrame:
    """Features without NULLs, so that error rows can pass through a model too."""
    return require_features(df).withColumns({f: F.coalesce(F.col(f), F.lit(0)) for f in FEATURES})


def gram_stage(dim: int = 256) -> CharNGramHasher:
    return CharNGramHasher(inputCol="url", outputCol="_ngrams", numFeatures=dim)


def build_preprocessor(use_ngrams: bool = True, dim: int = 256, cuts: list[list[float]] | None = None) -> Pipeline:
    """31 standardised features (or, with ``cuts``, their cut numbers), 19 as they are, hashed n-grams."""
    if cuts is None:
        first = [
            VectorAssembler(inputCols=list(CONTINUOUS_FEATURES), outputCol="_cont"),
            StandardScaler(inputCol="_cont", outputCol="_scaled", withMean=True, withStd=True),
        ]
        leading = ["_scaled"]
    else:
        leading = [f"_cut_{c}" for c in CONTINUOUS_FEATURES]
        splits = [[-float("inf"), *c, float("inf")] for c in cuts]
        first = [Bucketizer(splitsArray=splits, inputCols=list(CONTINUOUS_FEATURES), outputCols=leading)]
    grams = [gram_stage(dim)] if use_ngrams else []
    tail = ["_ngrams"] if use_ngrams else []
    last = VectorAssembler(inputCols=[*leading, *PASSTHROUGH_FEATURES, *tail], outputCol="features")
    return Pipeline(stages=[*first, *grams, last])


def random_cuts(train: DataFrame, seed: int, count: int = RANDOM_CUTS) -> list[list[float]]:
    """Uniform random cut points between minimum and maximum of each scaled feature."""
    row = train.agg(
        *[F.min(c).cast("double").alias(f"lo_{c}") for c in CONTINUOUS_FEATURES],
        *[F.max(c).cast("double").alias(f"hi_{c}") for c in CONTINUOUS_FEATURES],
    ).first()
    rng = np.random.default_rng(seed)
    cuts = []
    for c in CONTINUOUS_FEATURES:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        points = rng.uniform(lo, hi, count) if hi > lo else [lo]
        cuts.append(sorted({float(p) for p in points}))
    return cuts


def label_counts(train: DataFrame) -> dict[int, int]:
    return {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}


def balanced_weight(n: dict[int, int]) -> Column:
    """n / (2 * n_class) per row."""
    total = sum(n.values())
    return F.when(F.col("label") == 1, total / (2 * max(n.get(1, 0), 1))).otherwise(total / (2 * max(n.get(0, 0), 1)))


def _second(column: str) -> Column:
    return vector_to_array(F.col(column))[1]


@dataclass
class Member:
    """A preprocessing pipeline and one classifier on its vector."""

    prep: PipelineModel
    clf: RandomForestClassificationModel | GBTClassificationModel | LogisticRegressionModel

    def score(self, df: DataFrame, name: str = "probability", leaves: str = "") -> DataFrame:
        return _score_members(df, [self], [name], leaves)

    def save(self, path: str) -> None:
        self.prep.write().overwrite().save(f"{path}/prep")
        self.clf.write().overwrite().save(f"{path}/clf")


def tree_parts(model: Member | Blend | Calibrated, leaves: str) -> dict[str, RandomForestClassificationModel | GBTClassificationModel]:
    """The tree ensembles of a model, by the columns in which ``score(..., leaves=leaves)`` leaves the leaf numbers."""
    if isinstance(model, Calibrated):
        parts = [tree_parts(m, f"{leaves}{i}_") for i, (m, _) in enumerate(model.pairs)]
        return {column: clf for part in parts for column, clf in part.items()}
    members = model.members if isinstance(model, Blend) else [model]
    return {f"{leaves}{i}": m.clf for i, m in enumerate(members) if not isinstance(m.clf, LogisticRegressionModel)}


def _score_members(df: DataFrame, members: list[Member], names: list[str], leaves: str = "") -> DataFrame:
    """Add one probability column per member; members with the same preprocessing share its vector.

    With ``leaves`` the tree ensembles also add the leaf of each tree, see ``tree_parts``.
    """
    own = [c for c in df.columns if c not in names]
    out = df.select(*own)
    told = tree_parts(Blend(members), leaves) if leaves else {}
    by_prep: dict[int, list[int]] = {}
    for i, m in enumerate(members):
        by_prep.setdefault(id(m.prep), []).append(i)
    added: list[str] = []
    for positions in by_prep.values():
        # NULL features (error rows) count as 0 inside, and come out as they were
        kept = out.withColumn("_as_given", F.struct(*FEATURES))
        seen = members[positions[0]].prep.transform(prepared(kept))
        for i in positions:
            clf = members[i].clf.copy()
            clf.setPredictionCol(f"_y{i}").setProbabilityCol(f"_p{i}").setRawPredictionCol(f"_raw{i}")
            if f"{leaves}{i}" in told:
                clf.setLeafCol(f"{leaves}{i}")
            seen = clf.transform(seen)
        restored = [F.col("_as_given")[c].alias(c) if c in FEATURES else F.col(c) for c in (*own, *added)]
        ended = [f"{leaves}{i}" for i in positions if f"{leaves}{i}" in told]
        added += [*[names[i] for i in positions], *ended]
        out = seen.select(*restored, *[_second(f"_p{i}").alias(names[i]) for i in positions], *ended)
    return out


@dataclass
class Blend:
    """Mean of several members, or a logistic model on their probabilities."""

    members: list[Member]
    meta: LogisticRegressionModel | None = None

    def score(self, df: DataFrame, name: str = "probability", leaves: str = "") -> DataFrame:
        own = [c for c in df.columns if c != name]
        columns = [f"_m{i}" for i in range(len(self.members))]
        out = _score_members(df.select(*own), self.members, columns, leaves)
        told = tree_parts(self, leaves) if leaves else {}
        if self.meta is None:
            p = sum((F.col(c) for c in columns), F.lit(0.0)) / len(columns)
        else:
            z = sum(
                (F.lit(float(w)) * F.col(c) for w, c in zip(self.meta.coefficients, columns)),
                F.lit(float(self.meta.intercept)),
            )
            p = 1.0 / (1.0 + F.exp(-z))
        return out.select(*own, p.alias(name), *told)

    def preps(self) -> tuple[list[PipelineModel], list[int]]:
        """The distinct preprocessing pipelines, and which one each member uses."""
        distinct: dict[int, PipelineModel] = {}
        for m in self.members:
            distinct.setdefault(id(m.prep), m.prep)
        order = list(distinct)
        return list(distinct.values()), [order.index(id(m.prep)) for m in self.members]

    def save(self, path: str) -> None:
        for i, prep in enumerate(self.preps()[0]):
            prep.write().overwrite().save(f"{path}/prep-{i}")
        for i, m in enumerate(self.members):
            m.clf.write().overwrite().save(f"{path}/clf-{i}")
        if self.meta is not None:
            self.meta.write().overwrite().save(f"{path}/meta")


# ------------------------------------------------------------------ fits ----


def _classifier(kind: str, cfg: JobConfig):
    if kind in ("rf", "extratrees"):
        return RandomForestClassifier(
            numTrees=cfg.n_estimators,
            maxDepth=cfg.max_depth,
            minInstancesPerNode=cfg.min_samples_leaf,
            featureSubsetStrategy="sqrt",
            bootstrap=kind == "rf",
            weightCol="_weight",
            seed=cfg.random_state + (kind != "rf"),
        )
    if kind == "hgb":
        return GBTClassifier(
            maxIter=cfg.boosting_iters,
            stepSize=cfg.boosting_rate,
            maxDepth=5,
            validationIndicatorCol="_validation",
            validationTol=BOOSTING_TOL,
            seed=cfg.random_state,
        )
    if kind == "sgd":
        return LogisticRegression(regParam=1e-4, elasticNetParam=0.15, maxIter=200, weightCol="_weight")
    raise ValueError(f"unknown model: {kind}")


def fit_members(train: DataFrame, kinds: tuple[str, ...], cfg: JobConfig) -> list[Member]:
    """Fit classifiers on the same rows; those with the same preprocessing share one vector table.

    ``extratrees`` stands for trees with random cuts and no bootstrap. Spark has
    none, so a forest without bootstrap chooses among random cut points laid over
    each feature beforehand.
    """
    train = prepared(train)
    counts = label_counts(train)
    weight = balanced_weight(counts).alias("_weight")
    # splits go by the bytes of the features, but the vectors made of them are many times larger
    tasks = -(-sum(counts.values()) // ROWS_A_TASK)
    if train.rdd.getNumPartitions() < tasks:
        held = [c for c in train.columns if c in ("label", "url", gram_stage().getOutputCol(), *FEATURES)]
        train = train.select(*held).repartition(tasks)
    members: dict[str, Member] = {}
    for random_trees in (False, True):
        chosen = [k for k in kinds if (k == "extratrees") is random_trees]
        if not chosen:
            continue
        cuts = random_cuts(train, cfg.random_state) if random_trees else None
        prep = build_preprocessor(cfg.use_ngram_embeddings, cfg.ngram_dim, cuts).fit(train)
        rows = prep.transform(train).select(
            F.col("label").cast("double").alias("label"),
            "features",
            weight,
            (F.pmod(hash_order(["url"], cfg.random_state), F.lit(10.0)) == 0).alias("_validation"),
        ).persist(StorageLevel.MEMORY_AND_DISK)
        if "hgb" in chosen and train.sparkSession.sparkContext.getCheckpointDir() is None:
            # each round adds to the lineage of the errors: without a folder it would never be cut
            train.sparkSession.sparkContext.setCheckpointDir(shared_folder(train.sparkSession, "boosting"))
        for kind in chosen:
            members[kind] = Member(prep, _classifier(kind, cfg).fit(rows))
        rows.unpersist()
    return [members[k] for k in kinds]


BASES = ("rf", "extratrees", "hgb")


def fit_voting(train: DataFrame, cfg: JobConfig) -> Blend:
    return Blend(fit_members(train, BASES, cfg))


def fit_stack(train: DataFrame, cfg: JobConfig, key: tuple[str, ...] = ("url",), folds: int = 3) -> Blend:
    """Out-of-fold probabilities of the bases train the logistic top; the bases are refit on all rows."""
    placed = stratified_folds(train, key, folds, cfg.random_state)
    columns = [f"_m{i}" for i in range(len(BASES))]
    pooled = None
    for fold in range(folds):
        bases = Blend(fit_members(placed.filter(F.col("fold") != fold), BASES, cfg))
        held = _score_members(placed.filter(F.col("fold") == fold), bases.members, columns).select("label", *columns)
        # the top is fitted in several passes: the bases score a row once
        held = written(held, "fold-scores")
        pooled = held if pooled is None else pooled.unionByName(held)
    top = VectorAssembler(inputCols=columns, outputCol="features").transform(pooled)
    # an inverse penalty of 1 on the summed loss is 1/n on the mean loss
    meta = LogisticRegression(regParam=1.0 / max(train.count(), 1), standardization=False, maxIter=1000).fit(
        top.withColumn("label", F.col("label").cast("double"))
    )
    return Blend(fit_members(train, BASES, cfg), meta)


def fit_model(
    train: DataFrame, model_type: str, cfg: JobConfig, key: tuple[str, ...] = ("url",)
) -> Member | Blend:
    """Fit the model type; ``key`` must name columns that tell rows apart."""
    kind = model_type.lower()
    if kind == "voting":
        return fit_voting(train, cfg)
    if kind == "stack":
        return fit_stack(train, cfg, key)
    return fit_members(train, (kind,), cfg)[0]


# ----------------------------------------------------------- calibration ----


@dataclass
class Sigmoid:
    slope: float
    offset: float

    def apply(self, p: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-(self.slope * p + self.offset)))


def fit_sigmoid(scored: DataFrame, name: str = "probability") -> Sigmoid:
    """Platt scaling with smoothed targets: each row counts as both labels, with weights t and 1-t."""
    n = {r["label"]: r["count"] for r in scored.groupBy("label").count().collect()}
    high, low = (n.get(1, 0) + 1) / (n.get(1, 0) + 2), 1 / (n.get(0, 0) + 2)
    t = F.when(F.col("label") == 1, high).otherwise(low)
    both = scored.select(
        F.col(name).alias("p"),
        F.inline(
            F.array(
                F.struct(F.lit(1.0).alias("y"), t.alias("w")),
                F.struct(F.lit(0.0).alias("y"), (1 - t).alias("w")),
            )
        ),
    )
    # equal (score, label) rows are merged: the same fit from fewer rows
    merged = both.groupBy("p", "y").agg(F.sum("w").alias("w"))
    rows = VectorAssembler(inputCols=["p"], outputCol="x").transform(merged)
    fit = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=0.0, maxIter=200).fit(rows)
    return Sigmoid(float(fit.coefficients[0]), float(fit.intercept))


def fit_isotonic(scored: DataFrame, name: str = "probability") -> IsotonicRegressionModel:
    points = scored.groupBy(F.col(name).alias("x")).agg(
        F.avg(F.col("label").cast("double")).alias("y"), F.count("*").cast("double").alias("w")
    )
    return IsotonicRegression(featuresCol="x", labelCol="y", weightCol="w", predictionCol="_iso").fit(points)


@dataclass
class Calibrated:
    """Mean over the folds of (model fitted on the rest, calibrator fitted on the fold)."""

    pairs: list[tuple[Member | Blend, Sigmoid | IsotonicRegressionModel]]

    def score(self, df: DataFrame, name: str = "probability", leaves: str = "") -> DataFrame:
        own = [c for c in df.columns if c != name]
        out = df.select(*own)
        columns = [f"_c{i}" for i in range(len(self.pairs))]
        told = tree_parts(self, leaves) if leaves else {}
        for i, (column, (model, calibrator)) in enumerate(zip(columns, self.pairs)):
            out = model.score(out, column, leaves and f"{leaves}{i}_")
            if isinstance(calibrator, Sigmoid):
                out = out.withColumn(column, calibrator.apply(F.col(column)))
            else:
                mapped = calibrator.transform(out.withColumn("x", F.col(column)))
                out = mapped.withColumn(column, F.col("_iso")).drop("x", "_iso")
        return out.select(*own, (sum((F.col(c) for c in columns), F.lit(0.0)) / len(columns)).alias(name), *told)

    def save(self, path: str) -> None:
        for i, (model, calibrator) in enumerate(self.pairs):
            model.save(f"{path}/fold-{i}")
            if not isinstance(calibrator, Sigmoid):
                calibrator.write().overwrite().save(f"{path}/fold-{i}/isotonic")


def calibrate(
    train: DataFrame,
    fit: Callable[[DataFrame], Member | Blend],
    method: str = "sigmoid",
    folds: int = 3,
    key: tuple[str, ...] = ("url",),
    seed: int = 42,
) -> Member | Blend | Calibrated:
    method = "sigmoid" if method == "auto" else method
    if method == "none":
        return fit(train)
    placed = stratified_folds(train, key, folds, seed)
    pairs = []
    for fold in range(folds):
        model = fit(placed.filter(F.col("fold") != fold).drop("fold"))
        held = model.score(placed.filter(F.col("fold") == fold)).select("label", "probability")
        held = written(held, "fold-scores")
        pairs.append((model, fit_sigmoid(held) if method == "sigmoid" else fit_isotonic(held)))
    return Calibrated(pairs)


# ------------------------------------------------------------ validation ----

# The scores reported by cross-validation.
CV_SCORES = ("accuracy", "balanced_accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


def cross_validate(
    df: DataFrame,
    fit: Callable[[DataFrame], Member | Blend],
    k: int = 5,
    seed: int = 42,
    key: tuple[str, ...] = ("url",),
) -> DataFrame:
    """(metric, mean, std): mean and population deviation over the folds, at threshold 0.5."""
    placed = stratified_folds(df, key, k, seed)
    per_fold = None
    for fold in range(k):
        model = fit(placed.filter(F.col("fold") != fold).drop("fold"))
        held = model.score(placed.filter(F.col("fold") == fold)).select("label", F.col("probability").alias("score"))
        row = binary_metrics(written(held, "fold-scores"), 0.5).select(*CV_SCORES)
        per_fold = row if per_fold is None else per_fold.unionByName(row)
    stats = [
        F.struct(F.lit(m).alias("metric"), F.avg(m).alias("mean"), F.stddev_pop(m).alias("std")) for m in CV_SCORES
    ]
    return per_fold.agg(F.array(*stats).alias("s")).select(F.inline("s"))


RANGE_ROWS = 20_000
SCORE_RANGES = 256


def _numbered(df: DataFrame, group: list[str], order: list[Column | str], n: int, name: str) -> DataFrame:
    """Add ``name``: gapless from 1 within each group, in the order of a hash.

    Rows are dealt into ranges of the hash; each range is numbered by itself and
    starts where the ranges before it end, so no task holds a whole group.
    """
    h = F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in order])
    dealt = df.withColumn("_h", h).withColumn("_range", F.pmod("_h", F.lit(max(1, -(-n // RANGE_ROWS)))))
    sizes = dealt.groupBy(*group, "_range").agg(F.count("*").alias("_n"))
    ahead = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(*group, "_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
    own = F.row_number().over(W.partitionBy(*group, "_range").orderBy("_h", *[c for c in order if isinstance(c, str)]))
    return dealt.withColumn("_own", own).join(starts, [*group, "_range"]).withColumn(name, F.col("_start") + F.col("_own")).drop("_h", "_range", "_start", "_own")


def _areas(counts: DataFrame, group: list[str]) -> DataFrame:
    """ROC area of each group from the positive and negative rows of each score, by running counts per range of scores."""
    counts = counts.groupBy(*group, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counts = counts.withColumn("_range", F.floor(F.col("score") * SCORE_RANGES))
    sums = counts.groupBy(*group, "_range").agg(F.sum("pos").alias("_pos"))
    above = W.partitionBy(*group).orderBy(F.desc("_range")).rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(*group, "_range", F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("_start"))
    own = F.sum("pos").over(W.partitionBy(*group, "_range").orderBy(F.desc("score")))
    stepped = counts.withColumn("_own", own).join(starts, [*group, "_range"]).withColumn("tp", F.col("_start") + F.col("_own"))
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2)) / (F.sum("pos") * F.sum("neg"))
    return stepped.groupBy(*group).agg(area.alias("auc"))


def flat_model(model: Member | Blend | Calibrated) -> FlatModel | None:
    """The model as flat arrays, if it is a forest or the calibrated folds of one."""
    pairs = [(m, c) for m, c in model.pairs] if isinstance(model, Calibrated) else [(model, None)]
    if not all(isinstance(m, Member) and (c is None or isinstance(c, Sigmoid)) for m, c in pairs):
        return None
    forests = [flat_forest(SparkSession.active(), m.prep, m.clf) for m, _ in pairs]
    if any(f is None for f in forests):
        return None
    return FlatModel(tuple(forests), tuple(None if c is None else (c.slope, c.offset) for _, c in pairs))


def _swapped_counts(rounds: DataFrame, donors: DataFrame, flat: FlatModel, columns: tuple[str, ...], grams: CharNGramHasher | None) -> DataFrame:
    """(_feature, _round, score, pos, neg) of all copies, which are made and scored a batch of rows at a time."""
    dim = grams.getNumFeatures() if grams is not None else 0
    order = (*CONTINUOUS_FEATURES, *PASSTHROUGH_FEATURES)
    numbers = lambda of, names: F.array(*[F.coalesce(of(c).cast("double"), F.lit(0.0)) for c in names])
    given = rounds.select("_round", "_pos", "label", numbers(F.col, order).alias("_x"), *([grams.getOutputCol()] if grams else []))
    others = donors.select("_round", "_pos", numbers(lambda c: F.col("_other")[c], columns).alias("_swap"))
    vector = grams.getOutputCol() if grams else None
    places = [order.index(c) for c in columns]
    shared = rounds.sparkSession.sparkContext.broadcast(flat.plain())
    names = ["", *columns]

    def scored(batches):
        model = FlatModel.of_plain(shared.value)
        for batch in batches:
            x, swap = matrix(batch.column("_x")), matrix(batch.column("_swap")) if columns else None
            x = np.concatenate([x, dense(batch.column(vector), dim)], axis=1) if vector else x
            label, turn = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("label", "_round"))
            swaps = [(place, swap[:, i]) for i, place in enumerate(places)]
            for name, p in zip(names, model.with_swaps(x, swaps)):
                for one in np.unique(turn) if name else [1]:  # the unshuffled baseline is needed once only
                    of_one = turn == one
                    scores, at = np.unique(p[of_one], return_inverse=True)
                    pos = np.bincount(at, weights=label[of_one], minlength=len(scores)).astype(np.int64)
                    neg = np.bincount(at, minlength=len(scores)) - pos
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(scores), pa.string()), pa.array(np.full(len(scores), one, np.int32)), pa.array(scores), pa.array(pos), pa.array(neg)],
                        ["_feature", "_round", "score", "pos", "neg"],
                    )

    both = given.join(others, ["_round", "_pos"])
    return both.mapInArrow(scored, "_feature string, _round int, score double, pos long, neg long")


def tested_features(model: Member | Blend | Calibrated) -> frozenset[str]:
    """The features that some tree of the model tests, or that have a weight in it."""
    if isinstance(model, Calibrated):
        return frozenset().union(*[tested_features(m) for m, _ in model.pairs])
    if isinstance(model, Blend):
        return frozenset().union(*[tested_features(m) for m in model.members])
    # the vector begins with the single features in this order
    order = (*CONTINUOUS_FEATURES, *PASSTHROUGH_FEATURES)
    weights = model.clf.coefficients if isinstance(model.clf, LogisticRegressionModel) else model.clf.featureImportances
    return frozenset(c for c, w in zip(order, weights.toArray()) if w != 0)


tested_features.__test__ = False  # its name begins like that of a test


def permutation_importance(
    df: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    repeats: int = 5,
    seed: int = 42,
    key: str = "url",
    columns: tuple[str, ...] = FEATURES,
    tested: frozenset[str] | None = None,
    grams: CharNGramHasher | None = None,
    model: Member | Blend | Calibrated | None = None,
) -> DataFrame:
    """(feature, mean, std): loss of ROC-AUC when one feature is shuffled, largest first.

    All rows take part. In each repeat a row takes the values of the row at another
    place, in the order of a hash; all copies - feature x repeat - are scored in one pass.
    Features that no part of the model tests (see ``tested_features``) lose nothing by it and
    need no copies. With ``grams`` a row's n-grams are hashed once for all its copies.
    With the ``model`` behind ``score``, forests and their calibrated folds are walked as flat arrays: a
    batch's copies stay in one task, and only trees that test the shuffled feature are walked again.
    """
    idle = [c for c in columns if tested is not None and c not in tested]
    columns = tuple(c for c in columns if c not in idle)
    df = grams.transform(df) if grams is not None else df
    n = df.count()
    placed = _numbered(df, [], [key, F.lit(seed)], n, "_pos")
    rounds = placed.select("*", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("_round"))
    donors = rounds.select("_round", F.struct(*columns).alias("_other"), F.col("_pos").alias("_from"))
    donors = _numbered(donors, ["_round"], ["_from", "_round", F.lit(seed)], n, "_pos").select("_round", "_pos", "_other")
    flat = flat_model(model) if model is not None else None
    if flat is not None:
        counts = _swapped_counts(rounds, donors, flat, columns, grams)
    else:
        names = F.array(F.lit(""), *[F.lit(c) for c in columns])
        copies = rounds.join(donors, ["_round", "_pos"]).select("*", F.explode(names).alias("_feature"))
        # the unshuffled baseline is needed once only
        copies = copies.filter("_feature <> '' OR _round = 1")
        swapped = copies.withColumns(
            {c: F.when(F.col("_feature") == c, F.col("_other")[c]).otherwise(F.col(c)) for c in columns}
        ).drop("_other")
        scored = score(swapped).select("_feature", "_round", "label", F.col("probability").alias("score"))
        counts = scored.select("_feature", "_round", "score", F.col("label").alias("pos"), (1 - F.col("label")).alias("neg"))
    aucs = _areas(counts, ["_feature", "_round"])
    if idle:
        still = aucs.filter("_feature = ''").select(F.explode(F.array(*[F.lit(c) for c in idle])).alias("_feature"), F.lit(1).alias("_round"), "auc")
        aucs = aucs.unionByName(still)
    # a row for each feature and repeat
    base = F.max(F.when(F.col("_feature") == "", F.col("auc"))).over(W.partitionBy())
    return (
        aucs.withColumn("drop", base - F.col("auc"))
        .filter("_feature <> ''")
        .groupBy(F.col("_feature").alias("feature"))
        .agg(F.avg("drop").alias("mean"), F.stddev_pop("drop").alias("std"))
        .orderBy(F.desc("mean"), "feature")
    )


# ----------------------------------------------------------- persistence ----


def _load_classifier(path: str):
    meta = SparkSession.active().read.text(f"{path}/metadata").first()[0]
    kinds = {
        "RandomForestClassificationModel": RandomForestClassificationModel,
        "GBTClassificationModel": GBTClassificationModel,
        "LogisticRegressionModel": LogisticRegressionModel,
    }
    return kinds[json.loads(meta)["class"].rsplit(".", 1)[1]].load(path)


def describe(model: Member | Blend | Calibrated) -> dict:
    """The shape of a model as plain data, to be saved next to its parts."""
    if isinstance(model, Member):
        return {"kind": "member"}
    if isinstance(model, Blend):
        return {"kind": "blend", "preps": model.preps()[1], "meta": model.meta is not None}
    return {
        "kind": "calibrated",
        "folds": [
            {
                "model": describe(m),
                "sigmoid": [c.slope, c.offset] if isinstance(c, Sigmoid) else None,
            }
            for m, c in model.pairs
        ],
    }


def load_parts(path: str, shape: dict) -> Member | Blend | Calibrated:
    if shape["kind"] == "member":
        return Member(PipelineModel.load(f"{path}/prep"), _load_classifier(f"{path}/clf"))
    if shape["kind"] == "blend":
        preps = [PipelineModel.load(f"{path}/prep-{i}") for i in range(max(shape["preps"]) + 1)]
        members = [Member(preps[p], _load_classifier(f"{path}/clf-{i}")) for i, p in enumerate(shape["preps"])]
        return Blend(members, LogisticRegressionModel.load(f"{path}/meta") if shape["meta"] else None)
    pairs = []
    for i, fold in enumerate(shape["folds"]):
        model = load_parts(f"{path}/fold-{i}", fold["model"])
        calibrator = (
            Sigmoid(*fold["sigmoid"])
            if fold["sigmoid"]
            else IsotonicRegressionModel.load(f"{path}/fold-{i}/isotonic").setPredictionCol("_iso")
        )
        pairs.append((model, calibrator))
    return Calibrated(pairs)
