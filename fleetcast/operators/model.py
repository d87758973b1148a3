"""Ranker fitting, scoring, evaluation and persistence (M3-M8).

The fit is Spark ML's distributed L-BFGS logistic regression.  The
reference's objective (L2 strength C = 1, no scaling) equals Spark's with
``regParam = 1/n`` over the n training rows and ``standardization=False``.
Scoring afterwards is a plain Column expression (``Ranker``), so inference
runs in whole-stage codegen rather than through ``model.transform``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetcast.functions.frames import cut_lineage
from fleetcast.functions.scoring import FEATURES, Ranker, predict_label, score
from fleetcast.operators.training import fit_medians, impute


def fit_ranker(train: DataFrame, features=FEATURES, label: str = "label", max_iter: int = 1000,
               c: float = 1.0) -> tuple[Ranker, PipelineModel]:
    """M2 + M3: fit medians on ``train``, impute, fit logistic regression.

    The training rows are cached: L-BFGS runs one aggregation per iteration.
    """
    features = list(features)
    medians = fit_medians(train, features)
    rows = impute(train.select(*features, F.col(label).cast("double").alias("label")), medians).persist()
    try:
        n = rows.count()
        asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
        lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter,
                                regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False,
                                fitIntercept=True, tol=1e-10)
        model = Pipeline(stages=[asm, lr]).fit(rows)
    finally:
        rows.unpersist()
    lrm = model.stages[-1]
    coef = lrm.coefficients.toArray().tolist()
    ranker = Ranker(intercept=float(lrm.intercept), weights=dict(zip(features, map(float, coef))),
                    impute=medians, features=tuple(features))
    return ranker, model


def feature_vector(df: DataFrame, ranker: Ranker, out: str = "features") -> DataFrame:
    """The ranker's features, imputed, as one vector column in its order; a value still missing is NaN."""
    from pyspark.ml.functions import array_to_vector

    parts = [F.coalesce(ranker.feature(f).cast("double"), F.lit(float("nan"))) for f in ranker.features]
    return df.withColumn(out, array_to_vector(F.array(*parts)))


def score_rows(df: DataFrame, ranker: Ranker, out: str = "score") -> DataFrame:
    """M4 + M5: class-1 probability and the 0.5-threshold label."""
    s = score(ranker)
    return df.withColumn(out, s).withColumn("predicted", predict_label(F.col(out)))


def evaluate_ranker(scored: DataFrame, label: str = "label", score_col: str = "score",
                    eps: float = 2.220446049250313e-16) -> dict:
    """M6: AUC (exact, ties count half), accuracy at 0.5, mean clipped log loss."""
    scored = scored.select(label, score_col).persist()  # read by the aggregate and by the AUC
    y = F.col(label).cast("double")
    p = F.least(F.greatest(F.col(score_col), F.lit(eps)), F.lit(1 - eps))
    row = scored.agg(
        F.avg((predict_label(F.col(score_col)) == F.col(label).cast("int")).cast("double")).alias("accuracy"),
        F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"),
        F.count(F.lit(1)).alias("n")).first()
    auc = BinaryClassificationEvaluator(rawPredictionCol=score_col, labelCol=label,
                                        metricName="areaUnderROC", numBins=0).evaluate(
        scored.select(F.col(score_col).cast("double").alias(score_col), y.alias(label)))
    scored.unpersist()
    return {"auc": float(auc), "accuracy": float(row["accuracy"]), "log_loss": float(row["log_loss"]),
            "n": int(row["n"])}


def save_ranker(spark: SparkSession, ranker: Ranker, model: PipelineModel | None, path: str) -> None:
    """M7: Spark ML pipeline plus a one-row coefficient table (what serving reads)."""
    if model is not None:
        model.write().overwrite().save(f"{path}/pipeline")
    row = {"intercept": ranker.intercept, "features": list(ranker.features),
           "weights": json.dumps(ranker.weights), "impute": json.dumps(ranker.impute)}
    spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").parquet(f"{path}/coefficients")


def load_ranker(spark: SparkSession, path: str) -> Ranker:
    r = spark.read.parquet(f"{path}/coefficients").first()
    return Ranker(intercept=float(r["intercept"]), weights=json.loads(r["weights"]),
                  impute=json.loads(r["impute"]), features=tuple(r["features"]))


def save_ranker_version(spark: SparkSession, ranker: Ranker, model: PipelineModel | None, root: str) -> str:
    """M7: save below ``root`` under the next version number; earlier versions stay as they are."""
    found = _versions(spark, root)
    path = f"{root.rstrip('/')}/v={(found[-1] + 1 if found else 1):06d}"
    save_ranker(spark, ranker, model, path)
    return path


def load_newest_ranker(spark: SparkSession, root: str) -> Ranker:
    """The ranker of the newest version that was written completely."""
    found = _versions(spark, root)
    if not found:
        raise FileNotFoundError(f"no saved ranker below {root}")
    return load_ranker(spark, f"{root.rstrip('/')}/v={found[-1]:06d}")


def _versions(spark: SparkSession, root: str) -> list[int]:
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    return sorted(int(st.getPath().getName()[2:]) for st in fs.listStatus(top)
                  if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "coefficients/_SUCCESS")))


def loss_gradient(rows: DataFrame, ranker: Ranker, label: str = "label", c: float = 1.0) -> dict[str, float]:
    """Gradient of the regularised mean loss at the ranker's weights, each part relative to its feature's size."""
    x = {f: ranker.feature(f) for f in ranker.features}
    off = score(ranker) - F.col(label).cast("double")
    got = rows.agg(F.count(F.lit(1)).alias("n"), F.avg(off).alias("intercept"),
                   *[F.avg(off * v).alias(f) for f, v in x.items()],
                   *[F.avg(F.abs(v)).alias(f"{f}_size") for f, v in x.items()]).first()
    out = {f: (got[f] + ranker.weights[f] / (c * got["n"])) / got[f"{f}_size"] for f in x}
    return {"intercept": got["intercept"], **out}


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/pipeline")


def record_run(spark: SparkSession, runs_path: str, params: dict, metrics: dict,
               model_path: str | None = None) -> DataFrame:
    """M8: append one record of params and metrics to the runs table."""
    row = {"run_id": uuid.uuid4().hex, "recorded_at": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
           "params": json.dumps(params, sort_keys=True, default=str),
           "metrics": json.dumps(metrics, sort_keys=True), "model_path": model_path}
    df = spark.createDataFrame([row], "run_id string, recorded_at timestamp_ntz, params string, "
                                      "metrics string, model_path string")
    df.write.mode("append").parquet(runs_path)
    return df


def train_ranker(training: DataFrame, features=FEATURES, seed: int = 42, stats_path: str | None = None,
                 model_path: str | None = None, runs_path: str | None = None):
    """Q3: split → impute + fit → evaluate both splits → baseline stats → save → record."""
    from fleetcast.operators.quality import feature_baseline
    from fleetcast.operators.training import stratified_split
    from fleetcast.sources.online_store import write_stats

    spark = training.sparkSession
    split = cut_lineage(stratified_split(training, seed=seed))
    train = split.where(F.col("split") == "train")
    val = split.where(F.col("split") == "val")
    ranker, model = fit_ranker(train, features)
    metrics = {}
    for name, part in (("train", train), ("val", val)):
        m = evaluate_ranker(score_rows(part, ranker))
        metrics.update({f"{name}_auc": m["auc"], f"{name}_accuracy": m["accuracy"],
                        f"{name}_log_loss": m["log_loss"]})
    stats = feature_baseline(train, list(features))
    if stats_path:
        write_stats(stats, stats_path)
    if model_path:
        save_ranker(spark, ranker, model, model_path)
    if runs_path:
        params = {"seed": seed, "c": 1.0, "columns": list(features),
                  "rows": {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}}
        record_run(spark, runs_path, params, metrics, model_path)
    return ranker, metrics, stats
