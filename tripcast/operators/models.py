"""Demand models.

A fitted ``DemandModel`` is a category encoder, a regressor (a ``forest`` or the
boosted trees of ``boosting``) and small scoring parameters: target transform,
prediction cap, blend weight, calibration (linear line or isotonic fit) and an
optional residual-correction table.  Scoring is one pass of the regressor followed by
column expressions, so it runs wherever the rows are.
"""
from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import (CATEGORICAL_FEATURES, NUMERIC_FEATURES, PREDICTION_CAP_FACTOR, PREDICTION_CAP_QUANTILE,
                         RESIDUAL_MIN_SEGMENT_ROWS, RESIDUAL_SHRINKAGE)
from . import boosting
from .boosting import BoostedTrees, BoostSpec
from .forest import Forest, ForestSpec
from .isotonic import IsotonicFit
from ..session import ship_package


# ---------------------------------------------------------------------------
# features (M3, F25)
# ---------------------------------------------------------------------------
def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    cols = set(df.columns)
    return [c for c in CATEGORICAL_FEATURES if c in cols], [c for c in NUMERIC_FEATURES if c in cols]


def prepare_numeric(df: DataFrame) -> DataFrame:
    """every numeric feature present (missing ones as 0), nulls as 0, as double."""
    missing = {c: F.lit(0.0) for c in NUMERIC_FEATURES if c not in df.columns}
    out = df.withColumns(missing) if missing else df
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in NUMERIC_FEATURES})


def encoder_stages(cats: list[str], nums: list[str]) -> list:
    """Ordinal codes for categories (alphabetical, unseen -> extra code) + assembly.

    Codes enter the assembler as plain numbers (+ 0.0 drops the nominal
    metadata), so trees split on them as ordered values rather than needing
    ``maxBins`` >= the number of stations.
    """
    # one indexer: a single pass over the training rows for all categories
    stages = [StringIndexer(inputCols=cats, outputCols=[f"{c}__idx" for c in cats], handleInvalid="keep",
                            stringOrderType="alphabetAsc")] if cats else []
    return stages, [f"{c}__code" for c in cats] + nums


def add_codes(df: DataFrame, cats: list[str], labels: dict[str, list[str]]) -> DataFrame:
    return df.withColumns({
        f"{c}__code": F.when(F.col(f"{c}__idx") >= len(labels[c]), F.lit(-1.0)).otherwise(F.col(f"{c}__idx") + 0.0)
        for c in cats})


# ---------------------------------------------------------------------------
# model specifications (M6, M7, M8)
# ---------------------------------------------------------------------------
def model_specs(fast: bool = False) -> dict:
    """Candidates by name.  FIXED VALUES: the settings of the three boosted variants, but for
    fewer rounds at a step that keeps rounds * step (16, 16.8 and 18)."""
    if fast:
        return {"random_forest": ForestSpec("random_forest", 80, "0.85", 10, 32),
                "gbt": BoostSpec("gbt", rounds=40, depth=5, eta=0.25, subsample=0.9, colsample=0.9,
                                 min_child_weight=2, reg_lambda=1.5)}
    specs = [
        ForestSpec("random_forest", 160, "0.75", 12, 64),
        BoostSpec("gbt", rounds=64, depth=6, eta=0.25, subsample=0.94, colsample=0.92, min_child_weight=1,
                  gamma=0.015, reg_lambda=1.8, reg_alpha=0.01),
        BoostSpec("gbt_smooth", rounds=64, depth=4, eta=0.2625, subsample=0.9, colsample=0.88, min_child_weight=4,
                  gamma=0.08, reg_lambda=3.2, reg_alpha=0.12),
        BoostSpec("gbt_robust", loss="pseudo_huber", rounds=64, depth=5, eta=0.28125, subsample=0.92, colsample=0.9,
                  min_child_weight=2, gamma=0.04, reg_lambda=2.6, reg_alpha=0.06),
        # the raw demand with the tweedie loss's own log link; settings of our own
        BoostSpec("gbt_tweedie", loss="tweedie", rounds=64, depth=6, eta=0.25, subsample=0.94, colsample=0.92,
                  gamma=0.015, reg_lambda=1.8, reg_alpha=0.01),
    ]
    return {s.name: s for s in specs}


# ---------------------------------------------------------------------------
# fitted model
# ---------------------------------------------------------------------------
@dataclass
class DemandModel:
    name: str
    pipeline: PipelineModel
    cats: list[str]
    nums: list[str]
    labels: dict[str, list[str]]
    log_target: bool
    prediction_cap: float
    blend_weight: float = 1.0
    calibration: str = "none"
    slope: float = 1.0
    intercept: float = 0.0
    isotonic: IsotonicFit | None = None
    residual_keys: list[str] = field(default_factory=list)
    residual_table: DataFrame | None = None
    residual_bias: float = 0.0

    # M12 + M14: one scoring chain that always ends on the demand scale (Q12)
    def raw(self, df: DataFrame) -> DataFrame:
        return self.regress(add_codes(self.pipeline.transform(prepare_numeric(df)), self.cats, self.labels))

    def regress(self, coded: DataFrame) -> DataFrame:
        """The regressor's output in ``prediction``, from rows that have their category codes."""
        ship_package(coded.sparkSession)
        return coded.withColumn("prediction", self.regressor_model.score())

    regressor_model: object = None

    def base_scores(self, df: DataFrame) -> DataFrame:
        """Regressor output on the demand scale, clipped to [0, cap], in ``_raw``.

        Everything after this step is column arithmetic and one small
        broadcast join, so callers that try many calibration settings
        materialise this once and call ``finish`` repeatedly.
        """
        scored = self.raw(df)
        scored = scored.withColumn("_raw", on_demand_scale(F.col("prediction"), self.log_target, self.prediction_cap))
        drop = [c for c in scored.columns if c.endswith("__idx") or c.endswith("__code")] + ["features", "prediction"]
        return scored.drop(*[c for c in drop if c in scored.columns])

    def finish(self, scored: DataFrame, out: str = "predicted_demand") -> DataFrame:
        """Blend -> calibrate -> clip -> residual correction -> clip."""
        p = F.col("_raw")
        if self.blend_weight < 1 and "historical_profile_demand" in scored.columns:
            p = F.lit(self.blend_weight) * p + F.lit(1 - self.blend_weight) * F.col("historical_profile_demand")
        scored = scored.withColumn("_p", p)
        if self.calibration == "isotonic" and self.isotonic is not None:
            scored = scored.withColumn("_p", self.isotonic.column(F.col("_p")))
        elif self.calibration == "linear":
            scored = scored.withColumn("_p", F.lit(self.slope) * F.col("_p") + F.lit(self.intercept))
        scored = scored.withColumn("_p", F.least(F.greatest(F.col("_p"), F.lit(0.0)), F.lit(self.prediction_cap)))
        if self.residual_keys and self.residual_table is not None:
            # count-filtered segments of a few categorical keys; null-safe on every key; AQE picks the join
            table = self.residual_table
            cond = None
            for k in self.residual_keys:
                c = scored[k].eqNullSafe(table[f"_rk_{k}"])
                cond = c if cond is None else cond & c
            scored = scored.join(table, cond, "left")
            adj = F.coalesce(F.col("_correction"), F.lit(self.residual_bias))
            scored = scored.withColumn("_p", F.least(F.greatest(F.col("_p") + F.lit(RESIDUAL_SHRINKAGE) * adj,
                                                                F.lit(0.0)), F.lit(self.prediction_cap)))
            scored = scored.drop(*[f"_rk_{k}" for k in self.residual_keys], "_correction")
        return scored.drop("_raw").withColumnRenamed("_p", out)

    def predict(self, df: DataFrame, out: str = "predicted_demand") -> DataFrame:
        return self.finish(self.base_scores(df), out)

    # S17
    def save(self, path: str, spark: SparkSession | None = None) -> None:
        spark = spark or SparkSession.getActiveSession()
        self.pipeline.write().session(spark).overwrite().save(os.path.join(path, "encoder"))
        self.regressor_model.save(spark, os.path.join(path, "regressor"))
        if self.isotonic is not None:
            self.isotonic.save(spark, os.path.join(path, "isotonic"))
        if self.residual_table is not None:
            self.residual_table.write.mode("overwrite").parquet(os.path.join(path, "residuals"))
        meta = {k: getattr(self, k) for k in ("name", "cats", "nums", "labels", "log_target", "prediction_cap",
                                               "blend_weight", "calibration", "slope", "intercept",
                                               "residual_keys", "residual_bias")}
        meta["regressor_class"] = type(self.regressor_model).__name__
        spark.createDataFrame([(json.dumps(meta),)], "meta string") \
            .coalesce(1).write.mode("overwrite").text(os.path.join(path, "meta"))

    @classmethod
    def load(cls, spark, path: str) -> "DemandModel":
        meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
        kind = meta.pop("regressor_class")
        iso_path = os.path.join(path, "isotonic")
        res_path = os.path.join(path, "residuals")
        model = cls(pipeline=PipelineModel.load(os.path.join(path, "encoder")), **meta)
        model.regressor_model = {"BoostedTrees": BoostedTrees, "Forest": Forest}[kind].load(
            spark, os.path.join(path, "regressor"))
        model.isotonic = IsotonicFit.load(spark, iso_path) if _exists(spark, iso_path) else None
        model.residual_table = spark.read.parquet(res_path) if _exists(spark, res_path) else None
        return model


def _exists(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def prediction_cap(train: DataFrame, target: str = "demand") -> float:
    """M4: max(q0.999 * 1.25, max, 1) of the training target."""
    row = train.agg(F.percentile(F.col(target).cast("double"), PREDICTION_CAP_QUANTILE).alias("q"),
                    F.max(F.col(target).cast("double")).alias("m")).first()
    q, m = row["q"] or 0.0, row["m"] or 0.0
    return max(q * PREDICTION_CAP_FACTOR, m, 1.0)


def feature_names(cats: list[str], nums: list[str]) -> list[str]:
    return [f"{c}__code" for c in cats] + nums


def log_target(target: str):
    """M5: what the candidates on the log scale are fitted to."""
    return F.log1p(F.col(target).cast("double"))


def on_demand_scale(prediction, log_target: bool, cap: float):
    """From the regressor's scale to demand, clipped to [0, cap]."""
    p = F.expm1(prediction) if log_target else prediction
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(cap))


@dataclass
class Encoder:
    """M3: category codes learned on the training rows, shared by all candidates."""
    pipeline: PipelineModel
    cats: list[str]
    nums: list[str]
    labels: dict[str, list[str]]

    @classmethod
    def fit(cls, train: DataFrame) -> "Encoder":
        cats, nums = feature_columns(train)
        pipeline = Pipeline(stages=encoder_stages(cats, nums)[0]).fit(train)
        labels = {c: list(own) for c, own in zip(cats, pipeline.stages[0].labelsArray)} if cats else {}
        return cls(pipeline, cats, nums, labels)

    def codes(self, df: DataFrame) -> DataFrame:
        out = add_codes(self.pipeline.transform(df), self.cats, self.labels)
        return out.drop(*[f"{c}__idx" for c in self.cats])

    def model(self, spec, cap: float, regressor) -> DemandModel:
        out = DemandModel(name=spec.name, pipeline=self.pipeline, cats=self.cats, nums=self.nums, labels=self.labels,
                          log_target=spec.log_target, prediction_cap=cap)
        out.regressor_model = regressor
        return out


def fit_candidates(coded: DataFrame, encoder: Encoder, specs: list, cap: float, scopes: dict,
                   target: str = "demand", trace: list | None = None) -> dict[tuple[str, str], DemandModel]:
    """(candidate, scope) -> model.  All boosted candidates and scopes grow in the same jobs;
    forests are fitted beside them, for the first scope only, on the same binned rows."""
    first = next(iter(scopes))
    features = feature_names(encoder.cats, encoder.nums)
    forests = [s for s in specs if isinstance(s, ForestSpec)]
    boosted = {s.name: s for s in specs if isinstance(s, BoostSpec)}
    tables = {b: boosting.bin_rows(coded, features, target, scopes, b)
              for b in {s.bins for s in forests} | ({boosting.MAX_BINS} if boosted else set())}

    def fit_forests():
        return {(s.name, first): encoder.model(s, cap, s.regressor().fit(tables[s.bins], first)) for s in forests}

    # the forest's jobs run beside the boosted rounds, which are many and short
    with ThreadPoolExecutor(1) as pool:
        beside = pool.submit(inheritable_thread_target(coded.sparkSession)(fit_forests))
        trees = boosting.fit(coded, features, target, list(boosted.values()), scopes, trace=trace,
                             table=tables[boosting.MAX_BINS]) if boosted else {}
        out = beside.result()
    return out | {key: encoder.model(boosted[key[0]], cap, t) for key, t in trees.items()}


def fit_model(train: DataFrame, name: str, spec, cap: float, target: str = "demand") -> DemandModel:
    """M3 + M5: one candidate fitted on all rows given."""
    train = prepare_numeric(train)
    encoder = Encoder.fit(train)
    return fit_candidates(encoder.codes(train), encoder, [spec], cap, {"all": F.lit(True)}, target)[name, "all"]


def long_predictions(model: DemandModel, df: DataFrame, keys: list[str], target: str = "demand",
                     scored: bool = False) -> DataFrame:
    """Score rows into the long (model, keys, y, pred, profile) table of the evaluation operators.

    ``scored=True``: ``df`` already holds ``base_scores`` output; only the cheap
    finishing chain runs.
    """
    keep = [k for k in keys if k in df.columns]
    scored = model.finish(df) if scored else model.predict(df)
    return scored.select(F.lit(model.name).alias("model"), *keep, F.col(target).cast("double").alias("y"),
                         F.col("predicted_demand").alias("pred"),
                         F.col("historical_profile_demand").alias("profile"))


# ---------------------------------------------------------------------------
# residual correction
# ---------------------------------------------------------------------------
def residual_corrections(calibration: DataFrame, key_columns: list[str],
                         min_rows: int = RESIDUAL_MIN_SEGMENT_ROWS) -> DataFrame:
    """Median residual per segment with >= min_rows rows, shrunk by n / (n + min_rows).

    Sizes and medians come from value counts in spillable windows, so no segment's residuals
    are held in one task's buffer.
    """
    from .stats import segment_medians
    found = segment_medians(calibration, key_columns, "residual", min_rows, "_med", "_n").where("_med is not null")
    return found.select(*[F.col(k).alias(f"_rk_{k}") for k in key_columns],
                        (F.col("_med") * (F.col("_n") / (F.col("_n") + min_rows))).alias("_correction"))


def feature_importance(model: DemandModel) -> list[tuple[str, float]]:
    """(feature, importance) sorted."""
    reg = model.regressor_model
    return sorted(zip(model.cats + model.nums, (float(v) for v in reg.importances())), key=lambda x: -x[1])
