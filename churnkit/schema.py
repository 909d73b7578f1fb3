"""Schemas and fixed domain values of the subscriber data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the raw subscriber record.
# --- raw subscriber record (CSV with header; 21 columns) -------------------------
SUBSCRIBER_RAW = T.StructType([
    T.StructField("customerID", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("SeniorCitizen", T.IntegerType()),
    T.StructField("Partner", T.StringType()),
    T.StructField("Dependents", T.StringType()),
    T.StructField("tenure", T.IntegerType()),
    T.StructField("PhoneService", T.StringType()),
    T.StructField("MultipleLines", T.StringType()),
    T.StructField("InternetService", T.StringType()),
    T.StructField("OnlineSecurity", T.StringType()),
    T.StructField("OnlineBackup", T.StringType()),
    T.StructField("DeviceProtection", T.StringType()),
    T.StructField("TechSupport", T.StringType()),
    T.StructField("StreamingTV", T.StringType()),
    T.StructField("StreamingMovies", T.StringType()),
    T.StructField("Contract", T.StringType()),
    T.StructField("PaperlessBilling", T.StringType()),
    T.StructField("PaymentMethod", T.StringType()),
    T.StructField("MonthlyCharges", T.DoubleType()),
    T.StructField("TotalCharges", T.StringType()),
    T.StructField("Churn", T.StringType()),
])

RAW_COLUMNS = [f.name for f in SUBSCRIBER_RAW.fields]

# --- scoring request (JSON records) -----------------------------------------------
# Request field defaults, in field order.
REQUEST_DEFAULTS = {
    "gender": "Male",
    "SeniorCitizen": 0,
    "Partner": "No",
    "Dependents": "No",
    "tenure": 1,
    "PhoneService": "Yes",
    "MultipleLines": "No",
    "InternetService": "Fiber optic",
    "OnlineSecurity": "No",
    "OnlineBackup": "No",
    "DeviceProtection": "No",
    "TechSupport": "No",
    "StreamingTV": "No",
    "StreamingMovies": "No",
    "Contract": "Month-to-month",
    "PaperlessBilling": "Yes",
    "PaymentMethod": "Electronic check",
    "MonthlyCharges": 70.0,
    "TotalCharges": 70.0,
}

REQUEST = T.StructType(
    [T.StructField("customerID", T.StringType())]
    + [T.StructField(f.name, T.DoubleType() if f.name == "TotalCharges" else f.dataType)
       for f in SUBSCRIBER_RAW.fields if f.name in REQUEST_DEFAULTS]
)

# --- fixed domain values ---------------------------------------------------------
# Column groups used by the engineered features.
SECURITY_COLS = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport"]
STREAMING_COLS = ["StreamingTV", "StreamingMovies"]
SERVICE_COLS = ["PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
                "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
                "StreamingMovies"]
NO_SERVICE_VALUES = ["No", "No phone service", "No internet service"]

# Contract -> risk score.
CONTRACT_RISK = {"Month-to-month": 3, "One year": 2, "Two year": 1}

# Tenure buckets, right-closed upper bounds and labels.
TENURE_BOUNDS = [6, 12, 24, 48, 72]
TENURE_LABELS = ["0-6mo", "6-12mo", "1-2yr", "2-4yr", "4-6yr", "6yr+"]

# Allowed values per categorical field (request validation).
DOMAINS = {
    "gender": ["Male", "Female"],
    "Partner": ["Yes", "No"],
    "Dependents": ["Yes", "No"],
    "PhoneService": ["Yes", "No"],
    "MultipleLines": ["Yes", "No", "No phone service"],
    "InternetService": ["Fiber optic", "DSL", "No"],
    "OnlineSecurity": ["Yes", "No", "No internet service"],
    "OnlineBackup": ["Yes", "No", "No internet service"],
    "DeviceProtection": ["Yes", "No", "No internet service"],
    "TechSupport": ["Yes", "No", "No internet service"],
    "StreamingTV": ["Yes", "No", "No internet service"],
    "StreamingMovies": ["Yes", "No", "No internet service"],
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaperlessBilling": ["Yes", "No"],
    "PaymentMethod": ["Electronic check", "Mailed check", "Bank transfer (automatic)",
                      "Credit card (automatic)"],
}
# Numeric ranges (inclusive).
RANGES = {"SeniorCitizen": (0, 1), "tenure": (0, 72), "MonthlyCharges": (18.0, 120.0),
          "TotalCharges": (0.0, 9000.0)}

# Categorical columns, one-hot encoded, in table order; tenure_group last with a fixed level order.
CATEGORICAL_COLS = ["gender", "Partner", "Dependents", "PhoneService", "MultipleLines",
                    "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
                    "TechSupport", "StreamingTV", "StreamingMovies", "Contract",
                    "PaperlessBilling", "PaymentMethod"]
ORDERED_CATEGORICALS = {"tenure_group": TENURE_LABELS}

# Numeric model inputs, in vector order (the label Churn is kept outside the vector).
NUMERIC_FEATURES = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges",
                    "avg_monthly_spend", "security_bundle_count", "has_security_bundle",
                    "streaming_bundle_count", "has_streaming_bundle", "is_new_customer",
                    "contract_risk_score", "num_services", "monthly_charge_per_service",
                    "overpay_ratio"]

LABEL = "Churn"
KEY = "customerID"
# What a profile quotes of the texts that encoding drops.
PROFILE_TEXTS = ("Contract", "InternetService")
