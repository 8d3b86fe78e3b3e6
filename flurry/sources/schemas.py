"""Declared schemas of the inputs the operators were designed around."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column layout of the telco churn table -------------------
# Names, order and types must equal the published churn table so that a file
# written for it scans without inference.
CHURN_COLUMNS = [
    ("customerID", "string"),
    ("gender", "string"),
    ("SeniorCitizen", "string"),
    ("Partner", "string"),
    ("Dependents", "string"),
    ("tenure", "double"),
    ("PhoneService", "string"),
    ("MultipleLines", "string"),
    ("InternetService", "string"),
    ("OnlineSecurity", "string"),
    ("OnlineBackup", "string"),
    ("DeviceProtection", "string"),
    ("TechSupport", "string"),
    ("StreamingTV", "string"),
    ("StreamingMovies", "string"),
    ("Contract", "string"),
    ("PaperlessBilling", "string"),
    ("PaymentMethod", "string"),
    ("MonthlyCharges", "double"),
    ("TotalCharges", "double"),
    ("Churn", "string"),
]
CHURN_LABEL = "Churn"
CHURN_ID = "customerID"
# ---------------------------------------------------------------------------

CHURN_SCHEMA = T.StructType([T.StructField(c, T.DoubleType() if kind == "double" else T.StringType(), True) for c, kind in CHURN_COLUMNS])

# Features used for modelling: every column but the id and the label, by type.
CHURN_NUMERIC = [c for c, kind in CHURN_COLUMNS if kind == "double"]
CHURN_CATEGORICAL = [c for c, kind in CHURN_COLUMNS if kind == "string" and c not in (CHURN_ID, CHURN_LABEL)]
CHURN_FEATURES = [c for c, _ in CHURN_COLUMNS if c not in (CHURN_ID, CHURN_LABEL)]

# Metric log record: uuid, model ids, start/end epoch ms and nested metrics.
METRIC_LOG_SCHEMA = T.StructType([
    T.StructField("uuid", T.StringType(), True),
    T.StructField("model_crn", T.StringType(), True),
    T.StructField("model_deployment_crn", T.StringType(), True),
    T.StructField("startTimeStampMs", T.LongType(), True),
    T.StructField("endTimeStampMs", T.LongType(), True),
    T.StructField("metrics", T.StructType([
        T.StructField("input_data", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("probability", T.DoubleType(), True),
        T.StructField("explanation", T.MapType(T.StringType(), T.DoubleType()), True),
        T.StructField("final_label", T.BooleanType(), True),
        T.StructField("accuracy", T.DoubleType(), True),
    ]), True),
])

# Scored row: id, the request data, probability and explanation weights.
def scored_row_schema(data_schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("id", T.IntegerType(), True),
        T.StructField("data", data_schema, True),
        T.StructField("probability", T.DoubleType(), True),
        T.StructField("explanation", T.MapType(T.StringType(), T.DoubleType()), True),
    ])
