"""Gold dashboard table and its roll-ups (notebook 05)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from churnlens.functions.columns import (confidence_level, risk_category,
                                         tenure_category)

AT_RISK = ["High Risk", "Medium Risk"]


def probability_array(predictions: DataFrame) -> DataFrame:
    """Make ``probability`` an array of doubles (ML vectors are converted)."""
    if isinstance(predictions.schema["probability"].dataType, ArrayType):
        return predictions
    return predictions.withColumn("probability", vector_to_array("probability"))


def dashboard_rows(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """Predictions joined to customer facts plus the business columns.

    ``predictions``: customer_id, prediction, probability ([P(0), P(1)]).
    ``features``: customer_id, churn, tenure, monthly_charges, total_charges.
    """
    p = probability_array(predictions).select("customer_id", "prediction", "probability")
    f = features.select("customer_id", "churn", "tenure", "monthly_charges", "total_charges")
    d = p.join(f, "customer_id", "inner")
    prob = F.col("probability")[1]
    return d.select(
        "customer_id", "prediction", "probability", "churn", "tenure",
        "monthly_charges", "total_charges",
        prob.alias("churn_probability"),
        risk_category(prob).alias("risk_category"),
        F.when(F.col("prediction") == F.col("churn"), "Correct")
         .otherwise("Incorrect").alias("prediction_accuracy"),
        (F.col("monthly_charges") * F.lit(12)).alias("revenue_impact"),
        tenure_category("tenure").alias("tenure_category"),
    )


def risk_distribution(d: DataFrame) -> DataFrame:
    return (d.groupBy("risk_category")
            .agg(F.count(F.lit(1)).alias("customer_count"),
                 F.avg("churn_probability").alias("avg_churn_probability"),
                 F.avg("monthly_charges").alias("avg_monthly_charges"))
            .orderBy(F.desc("customer_count"), "risk_category"))


def tenure_risk(d: DataFrame) -> DataFrame:
    return (d.groupBy("tenure_category", "risk_category")
            .agg(F.count(F.lit(1)).alias("customer_count"),
                 F.avg("churn_probability").alias("avg_churn_probability"),
                 F.sum("revenue_impact").alias("total_revenue_impact"))
            .orderBy(F.desc("tenure_category"), F.desc("customer_count"), "risk_category"))


def revenue_at_risk(d: DataFrame) -> DataFrame:
    return (d.where(F.col("risk_category").isin(AT_RISK))
            .agg(F.count(F.lit(1)).alias("customers_at_risk"),
                 F.sum("revenue_impact").alias("revenue_at_risk"),
                 F.avg("churn_probability").alias("avg_churn_probability")))


def confidence_analysis(d: DataFrame) -> DataFrame:
    return (d.withColumn("confidence_level", confidence_level("churn_probability"))
            .groupBy("confidence_level")
            .agg(F.count(F.lit(1)).alias("customer_count"),
                 F.avg("churn_probability").alias("avg_churn_probability"),
                 F.avg("monthly_charges").alias("avg_monthly_charges"))
            .orderBy(F.desc("customer_count"), "confidence_level"))


def kpi_summary(d: DataFrame) -> DataFrame:
    """The nine dashboard KPIs from one aggregate (one scan of the table)."""
    n = F.count(F.lit(1))
    churned = F.count_if(F.col("churn") == 1)
    return d.agg(
        n.alias("total_customers"),
        churned.alias("churned_customers"),
        (churned / n).alias("churn_rate"),
        F.count_if(F.col("prediction") == 1).alias("predicted_churned"),
        (F.count_if(F.col("prediction_accuracy") == "Correct") / n).alias("prediction_accuracy"),
        F.count_if(F.col("risk_category") == "High Risk").alias("high_risk_customers"),
        F.count_if(F.col("risk_category") == "Medium Risk").alias("medium_risk_customers"),
        F.avg("churn_probability").alias("avg_churn_probability"),
        F.sum("revenue_impact").alias("total_revenue"),
    )
