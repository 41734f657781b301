"""Small table jobs: imaging catalogue, batch scoring, waste audit, invoice fields."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.operators.shape import union_all

# Header fields that may be catalogued: no pixels, names, dates of birth or ids of persons.
IMAGING_FIELDS = [
    "StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID", "Modality", "StudyDate",
    "BodyPartExamined", "Manufacturer", "Rows", "Columns", "SliceThickness",
]
INVOICE_FIELDS = ["vendor", "total", "date"]


def imaging_catalogue(documents: DataFrame) -> DataFrame:
    """One row per metadata document (`body`), allowed fields only."""
    shape = "struct<" + ",".join(f"`{name}`:string" for name in IMAGING_FIELDS) + ">"
    parsed = documents.select(F.from_json("body", shape).alias("d"))
    return parsed.select("d.*").where("SOPInstanceUID is not null")


def studies(catalogue: DataFrame, modality: str | None = None) -> DataFrame:
    """Studies with their number of series and images, optionally of one modality."""
    rows = catalogue if modality is None else catalogue.where(F.col("Modality") == modality)
    per_series = rows.groupBy("StudyInstanceUID", "Modality", "SeriesInstanceUID").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_series.groupBy("StudyInstanceUID", "Modality").agg(
        F.count("SeriesInstanceUID").alias("series"), F.sum("n").alias("images")
    )


def read_model(text: str) -> dict:
    """A stored linear model: `{"intercept": x, "weights": {column: weight}}`."""
    model = json.loads(text)
    return {"intercept": float(model["intercept"]), "weights": dict(model["weights"])}


def churn_scores(customers: DataFrame, model: dict, key: str, threshold: float = 0.5) -> DataFrame:
    """Probability from a logistic model as column arithmetic; missing inputs count as 0."""
    linear: Column = F.lit(model["intercept"])
    for column, weight in sorted(model["weights"].items()):
        linear = linear + F.coalesce(F.col(column).cast("double"), F.lit(0.0)) * weight
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-linear))
    return customers.select(key, probability.alias("churn_probability")).withColumn(
        "churn", F.col("churn_probability") >= threshold
    )


def train_churn(customers: DataFrame, features: list[str], label: str = "label") -> PipelineModel:
    """A logistic model of `label` (0 or 1) on scaled numeric columns; missing inputs count as 0."""
    rows = customers.select(F.col(label).cast("double").alias("label"), *features).fillna(0, features)
    stages = [
        VectorAssembler(inputCols=features, outputCol="_features"),
        StandardScaler(inputCol="_features", outputCol="_scaled", withMean=True),
        LogisticRegression(featuresCol="_scaled", labelCol="label", probabilityCol="_probability", regParam=0.01),
    ]
    return Pipeline(stages=stages).fit(rows)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def model_scores(customers: DataFrame, path: str, key: str, threshold: float = 0.5) -> DataFrame:
    """Probability and decision of a stored model for each customer."""
    model = PipelineModel.load(path)
    features = model.stages[0].getInputCols()
    scored = model.transform(customers.select(key, *features).fillna(0, features))
    probability = vector_to_array(F.col("_probability")).getItem(1)
    return scored.select(key, probability.alias("churn_probability")).withColumn(
        "churn", F.col("churn_probability") >= threshold
    )


def linear_form(path: str) -> dict:
    """A stored model as intercept and weights of the unscaled columns, as `churn_scores` takes it."""
    assembler, scaler, regression = PipelineModel.load(path).stages
    weights = [w / s if s else 0.0 for w, s in zip(regression.coefficients.toArray(), scaler.std.toArray())]
    shift = sum(w * m for w, m in zip(weights, scaler.mean.toArray()))
    named = dict(zip(assembler.getInputCols(), map(float, weights)))
    return {"intercept": float(regression.intercept - shift), "weights": named}


def waste_findings(
    instances: DataFrame,
    volumes: DataFrame,
    addresses: DataFrame,
    snapshots: DataFrame,
    as_of: dt.date,
    idle_cpu: float = 5.0,
    old_days: int = 90,
) -> DataFrame:
    """Idle machines, unattached volumes, unused addresses and old snapshots, by rule."""

    def found(df: DataFrame, rule: str, detail: Column) -> DataFrame:
        return df.select(
            F.lit(rule).alias("rule"),
            F.col("resource_id").cast("string").alias("resource_id"),
            detail.cast("string").alias("detail"),
        )

    age = F.date_diff(F.lit(as_of), F.col("created").cast("date"))
    return union_all(
        [
            found(instances.where(F.col("cpu_percent") < idle_cpu), "idle_instance", F.col("cpu_percent")),
            found(volumes.where(F.col("attached_to").isNull()), "unattached_volume", F.col("size_gb")),
            found(addresses.where(F.col("used_by").isNull()), "unused_address", F.lit(None)),
            found(snapshots.where(age > old_days), "old_snapshot", age),
        ]
    )


def waste_report(findings: DataFrame) -> DataFrame:
    return findings.groupBy("rule").agg(F.count(F.lit(1)).alias("findings"))


def invoice_fields(documents: DataFrame, key: str = "invoice_id") -> DataFrame:
    """Vendor, total and date from recognised fields `[{"key":..., "value":...}]` in `body`.

    Of several values for a field the smallest text is kept.
    """
    pairs = documents.select(
        key, F.explode(F.from_json("body", "array<struct<key:string,value:string>>")).alias("p")
    )
    name = F.lower(F.trim("p.key"))
    named = pairs.withColumn("_name", name).where(F.col("_name").isin(INVOICE_FIELDS))
    fields = named.groupBy(key).pivot("_name", INVOICE_FIELDS).agg(F.min(F.trim("p.value")))
    return fields.select(
        key,
        "vendor",
        F.regexp_replace("total", r"[^0-9.\-]", "").try_cast("decimal(18,2)").alias("total"),
        F.to_date(F.try_to_timestamp("date", F.lit("yyyy-MM-dd"))).alias("invoice_date"),
    )
