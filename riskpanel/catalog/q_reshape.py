"""Set operations and reshaping (2.7)."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.catalog.base import register
from riskpanel.operators.state import models_to_rows


@register("models_to_rows", "U1", """
SELECT district_code, prediction_horizon_weeks, model_name, avg(risk_score) AS risk_score
FROM risk_predictions GROUP BY ALL""", ["risk_score"])
def q_models_to_rows(t):
    """Mean score per model as one column per model, turned back into one row per model."""
    wide = (t.predictions.groupBy("district_code", "prediction_horizon_weeks")
            .pivot("model_name", C.MODEL_NAMES).agg(F.avg("risk_score")))
    return models_to_rows(wide, ["district_code", "prediction_horizon_weeks"])


@register("union_reports", "U3", """
SELECT 'cases' AS table_name, district_code, count(*) AS n_rows, min(case_date) AS start_date,
       max(case_date) AS end_date FROM cases GROUP BY 2
UNION ALL SELECT 'climate_data', district_code, count(*), min(date), max(date) FROM climate_data GROUP BY 2
UNION ALL SELECT 'risk_predictions', district_code, count(*), min(prediction_date), max(prediction_date)
FROM risk_predictions GROUP BY 2""")
def q_union_reports(t):
    """Per-table extents of every district in one frame (unionByName)."""
    def ext(df, name, col):
        return df.groupBy("district_code").agg(F.count(F.lit(1)).alias("n_rows"), F.min(col).alias("start_date"),
                                               F.max(col).alias("end_date")) \
            .select(F.lit(name).alias("table_name"), "district_code", "n_rows", "start_date", "end_date")
    return reduce(DataFrame.unionByName, [ext(t.cases, "cases", "case_date"),
                                          ext(t.climate, "climate_data", "date"),
                                          ext(t.predictions, "risk_predictions", "prediction_date")])
