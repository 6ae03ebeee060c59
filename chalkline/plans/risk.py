"""The weighted welfare risk index of each school."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.plans.star import Star
from chalkline.plans.views import school_kpis


@dataclass(frozen=True)
class RiskModel:
    """Weights, defaults for schools without facts, and cut-offs (fixed values by default)."""

    attendance_weight: float = 0.30
    learning_weight: float = 0.25
    infrastructure_weight: float = 0.20
    meals_weight: float = 0.15
    integrity_weight: float = 0.10

    default_attendance_rate: float = 75.0
    default_proxy_rate: float = 0.0
    default_deficit: float = 40.0
    default_infrastructure_score: float = 60.0
    default_score: float = 65.0
    default_meal_kg: float = 0.0

    expected_kg_per_student: float = 0.5
    meals_risk_below: float = 60.0
    meals_risk_met: float = 20.0

    moderate_from: float = 40.0
    high_from: float = 70.0


DEFAULT_MODEL = RiskModel()


def _within_100(c: Column) -> Column:
    """Clipped to 0..100, NULL kept (`greatest` alone would turn NULL into 0)."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(100.0)), F.lit(0.0)))


def welfare_risk(star: Star, model: RiskModel = DEFAULT_MODEL) -> DataFrame:
    """One row per school: its measures, five partial risks, the index and its band."""
    def known(name, default):
        return F.coalesce(F.col(name), F.lit(default))

    df = school_kpis(star).select(
        "school_id", "school_name", "district", "block", "total_enrolled_students",
        known("avg_attendance_rate", model.default_attendance_rate).alias("avg_attendance_rate"),
        known("proxy_anomaly_rate", model.default_proxy_rate).alias("proxy_anomaly_rate"),
        known("infrastructure_deficit_pct", model.default_deficit).alias("infrastructure_deficit_pct"),
        known("infrastructure_score", model.default_infrastructure_score).alias("infrastructure_score"),
        known("avg_fln_score", model.default_score).alias("avg_fln_score"),
        known("total_quantity_kg", model.default_meal_kg).alias("total_mdm_kg"),
    )
    short_of_meals = F.col("total_mdm_kg") < (
        F.col("total_enrolled_students") * model.expected_kg_per_student
    )
    df = df.withColumns({
        "attendance_risk": _within_100(100.0 - F.col("avg_attendance_rate")),
        "learning_risk": _within_100(100.0 - F.col("avg_fln_score")),
        "infrastructure_risk": _within_100(F.col("infrastructure_deficit_pct")),
        "mdm_risk": F.when(short_of_meals, model.meals_risk_below).otherwise(model.meals_risk_met),
        "integrity_risk": _within_100(F.col("proxy_anomaly_rate")),
    })
    # Sums of doubles differ in their last digits with the order rows arrive in; that noise is
    # rounded off first, so that a score halfway between two cents always goes to the even one.
    score = F.bround(F.round(
        F.col("attendance_risk") * model.attendance_weight
        + F.col("learning_risk") * model.learning_weight
        + F.col("infrastructure_risk") * model.infrastructure_weight
        + F.col("mdm_risk") * model.meals_weight
        + F.col("integrity_risk") * model.integrity_weight,
        9,
    ), 2)
    band = (
        F.when(F.col("welfare_risk_score") < model.moderate_from, F.lit("Low Risk"))
        .when(F.col("welfare_risk_score") >= model.high_from, F.lit("High Risk"))
        .otherwise(F.lit("Moderate Risk"))
    )
    return df.withColumn("welfare_risk_score", score).withColumn("welfare_risk_category", band)
