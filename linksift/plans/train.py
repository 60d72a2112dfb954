"""The training job: labelled URLs in, a scoring model and report tables out."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, replace

from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linksift.config import JobConfig, fingerprint
from linksift.constants import CONTINUOUS_FEATURES, FEATURES, SCHEMA_VERSION
from linksift.operators import models as M
from linksift.operators import reasons as R
from linksift.operators.bootstrap import bootstrap_ci
from linksift.operators.evaluate import (
    binary_metrics,
    calibration_curve,
    conformal_coverage,
    conformal_fit,
    dataset_counts,
    pr_curve,
    roc_curve,
    scan_thresholds,
    select_thresholds,
)
from linksift.operators.explain import explained_score
from linksift.operators.mutate import adversarial_probe
from linksift.operators.online import OnlineState, empty_state, state_from_table, state_table, with_online_prob
from linksift.operators.parse import with_url_features
from linksift.operators.scoring import Scorer, fit_risk
from linksift.operators.splits import half_split, stratified_split
from linksift.session import written


@dataclass
class TrainedModel:
    """Everything a scan needs, and what drift checks compare with."""

    model: M.Member | M.Blend | M.Calibrated
    threshold: float
    conformal_q: float | None
    conformal_n: int
    risk_model: IsotonicRegressionModel | None
    model_hash: str
    drift_reference: DataFrame | None = None
    online: OnlineState | None = None
    schema_version: int = SCHEMA_VERSION

    def scorer(self, explain: bool = True) -> Scorer:
        """What a scan needs; with ``explain`` every row gets its contributions too."""
        online = self.online
        return Scorer(
            score=explained_score(self.model) if explain else self.model.score,
            threshold=self.threshold,
            conformal_q=self.conformal_q if self.conformal_n else None,
            risk_model=self.risk_model,
            online=(lambda df: with_online_prob(df, online)) if online is not None and online.fitted else None,
            model_hash=self.model_hash,
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Model parts, settings as one JSON row, online state and drift reference as tables."""
        self.model.save(f"{path}/model")
        if self.risk_model is not None:
            self.risk_model.write().overwrite().save(f"{path}/risk")
        settings = {
            "shape": M.describe(self.model),
            "threshold": self.threshold,
            "conformal_q": self.conformal_q,
            "conformal_n": self.conformal_n,
            "risk": self.risk_model is not None,
            "model_hash": self.model_hash,
            "schema_version": self.schema_version,
            "feature_names": list(FEATURES),
            "online": self.online is not None,
            "drift": self.drift_reference is not None,
        }
        spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/settings"
        )
        if self.online is not None:
            state_table(spark, self.online).write.mode("overwrite").parquet(f"{path}/online")
        if self.drift_reference is not None:
            self.drift_reference.write.mode("overwrite").parquet(f"{path}/drift_reference")


def load_model(spark: SparkSession, path: str) -> TrainedModel:
    """Read a saved model; one of another schema version is refused."""
    settings = json.loads(spark.read.text(f"{path}/settings").first()[0])
    if settings["schema_version"] != SCHEMA_VERSION:
        raise ValueError(f"model has schema version {settings['schema_version']}, this code has {SCHEMA_VERSION}")
    risk = IsotonicRegressionModel.load(f"{path}/risk") if settings["risk"] else None
    return TrainedModel(
        M.load_parts(f"{path}/model", settings["shape"]),
        settings["threshold"],
        settings["conformal_q"],
        settings["conformal_n"],
        risk,
        settings["model_hash"],
        spark.read.parquet(f"{path}/drift_reference") if settings["drift"] else None,
        state_from_table(spark.read.parquet(f"{path}/online")) if settings["online"] else None,
    )


def labelled_features(df: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Readable rows of (url, label, ...) with features and the two reason sums."""
    parsed = with_url_features(df, keep_parts=True).filter(F.col("error").isNull())
    reasoned = R.with_heuristics(parsed)
    reasoned = R.apply_rules(reasoned, rules if rules is not None else R.default_rules(df.sparkSession))
    carried = [c for c in df.columns if c not in FEATURES]
    return reasoned.select(
        *carried,
        *FEATURES,
        R.reason_sum(F.concat("heuristic_reasons", "rule_reasons")).alias("reason_sum"),
        R.weight_sum(F.col("rule_reasons")).alias("rule_sum"),
    )


def train(
    labelled: DataFrame,
    cfg: JobConfig = JobConfig(),
    key: tuple[str, ...] = ("url",),
    rules: DataFrame | None = None,
) -> tuple[TrainedModel, dict[str, DataFrame]]:
    """Fit, calibrate, choose a threshold and measure. ``key`` names columns that tell rows apart.

    Threshold, conformal quantile and risk calibration use one half of the test
    part; the reported metrics use the other half.
    """
    spark = labelled.sparkSession
    # features and hashed n-grams are worked out once; the splits then read them
    features = labelled_features(labelled, rules)
    features = M.gram_stage(cfg.ngram_dim).transform(features) if cfg.use_ngram_embeddings else features
    split = written(stratified_split(written(features, "labelled"), key, cfg.test_size, cfg.random_state), "train-parts")
    halves = half_split(split.filter("part = 'test'"), key, cfg.random_state + 1)
    rows = written(halves.unionByName(split.filter("part = 'train'"), allowMissingColumns=True), "train-rows")
    fit_rows, test_rows = rows.filter("part = 'train'"), rows.filter("part = 'test'")

    def fit(df: DataFrame):
        return M.fit_model(df, cfg.model_type, cfg, key)

    cv = M.cross_validate(fit_rows, fit, cfg.cv_folds, cfg.random_state, key) if cfg.cv_folds > 1 else None
    method = cfg.calibration_method.lower() if cfg.use_calibration else "none"
    model = M.calibrate(fit_rows, fit, method, 3, key, cfg.random_state)

    scored = written(model.score(test_rows).withColumn("score", F.col("probability")), "test-scores")
    tuning, held = scored.filter("half = 'calibrate'"), scored.filter("half = 'evaluate'")
    scan = written(scan_thresholds(tuning, cfg.cost_fn, cfg.cost_fp), "threshold-scan")
    chosen = {r.criterion: r.threshold for r in select_thresholds(scan).collect()}
    threshold = cfg.decision_threshold if cfg.decision_threshold is not None else chosen["cost"]
    fitted = conformal_fit(tuning, cfg.conformal_alpha).first()
    risk_model = fit_risk(tuning)

    metrics = binary_metrics(held, threshold)
    coverage = conformal_coverage(held, fitted["q"])
    auc = metrics.first()["roc_auc"]
    model_hash = hashlib.sha256((fingerprint(cfg) + str(auc)).encode()).hexdigest()[:12]
    trained = TrainedModel(
        model, threshold, fitted["q"], fitted["n"], risk_model, model_hash,
        drift_reference=fit_rows.select(*CONTINUOUS_FEATURES),
        online=empty_state(),
    )

    thresholds = spark.createDataFrame([*chosen.items(), ("chosen", threshold)], "criterion string, threshold double")
    tables = {
        "config": spark.createDataFrame(
            [(json.dumps(asdict(cfg)), fingerprint(cfg), model_hash)], "config string, config_hash string, model_hash string"
        ).withColumn("timestamp", F.current_timestamp()),
        "dataset": dataset_counts(rows, ["part", "half"]),
        "thresholds": thresholds,
        "metrics": metrics,
        "intervals": bootstrap_ci(held, threshold, cfg.bootstrap_iters, seed=cfg.random_state + 1),
        "threshold_scan": scan,
        "roc_points": roc_curve(held),
        "pr_points": pr_curve(held),
        "calibration_curve": calibration_curve(held),
        "permutation_importance": M.permutation_importance(
            test_rows, model.score, cfg.permutation_repeats, cfg.random_state, key[0],
            tested=M.tested_features(model), grams=M.gram_stage(cfg.ngram_dim) if cfg.use_ngram_embeddings else None, model=model,
        ),
        "conformal": coverage.withColumns(
            {"alpha": F.lit(cfg.conformal_alpha), "q": F.lit(fitted["q"]), "n_calib": F.lit(fitted["n"])}
        ),
        "scores": held.select(*key, "label", "score"),
    }
    if cv is not None:
        tables["cross_validation"] = cv
    if cfg.adversarial_probe:
        tables["adversarial"] = adversarial_probe(
            labelled.filter("label = 1").select("url"),
            lambda df: verdicts(df, trained),
            cfg.adversarial_mutations,
            cfg.random_state,
        )
    return trained, tables


def verdicts(df: DataFrame, trained: TrainedModel) -> DataFrame:
    """Add ``verdict`` to a frame of URLs; unreadable ones count as 0."""
    scored = trained.model.score(with_url_features(df, flags=False))
    hit = F.col("error").isNull() & (F.col("probability") >= trained.threshold)
    return scored.withColumn("verdict", F.when(hit, 1).otherwise(0))


def with_online(trained: TrainedModel, state: OnlineState) -> TrainedModel:
    return replace(trained, online=state)
