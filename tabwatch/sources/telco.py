"""Contracts of the customer table the classifier life cycle was built around, and its
CSV reader. The values below are fixed: they must equal the source data's domains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType, StringType

from tabwatch.operators.contracts import ColumnSpec, Contract, validate
from tabwatch.operators.prep import fill_and_label

# Category domains of the customer table.
BINARY = ("Yes", "No")
PHONE_OPT = ("Yes", "No", "No phone service")
INTERNET_OPT = ("Yes", "No", "No internet service")
INTERNET_SERVICE = ("DSL", "Fiber optic", "No")
CONTRACT = ("Month-to-month", "One year", "Two year")
PAYMENT = ("Electronic check", "Mailed check", "Bank transfer (automatic)",
           "Credit card (automatic)")
GENDER = ("Female", "Male")

TARGET = "churn"
NUMERICAL = ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen"]
CATEGORICAL = ["gender", "Partner", "Dependents", "PhoneService", "MultipleLines",
               "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
               "TechSupport", "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling",
               "PaymentMethod"]

_DOMAINS = {
    "gender": GENDER, "Partner": BINARY, "Dependents": BINARY, "PhoneService": BINARY,
    "MultipleLines": PHONE_OPT, "InternetService": INTERNET_SERVICE,
    "OnlineSecurity": INTERNET_OPT, "OnlineBackup": INTERNET_OPT,
    "DeviceProtection": INTERNET_OPT, "TechSupport": INTERNET_OPT, "StreamingTV": INTERNET_OPT,
    "StreamingMovies": INTERNET_OPT, "Contract": CONTRACT, "PaperlessBilling": BINARY,
    "PaymentMethod": PAYMENT,
}

# Column order of the raw file.
RAW_ORDER = ["customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
             "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
             "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
             "Contract", "PaperlessBilling", "PaymentMethod", "MonthlyCharges", "TotalCharges",
             "Churn"]


def _feature_specs(tenure_max: int, total_nullable: bool, monthly_max: float | None = None):
    specs = []
    for name in RAW_ORDER[1:-1]:
        if name in _DOMAINS:
            specs.append(ColumnSpec(name, "string", isin=_DOMAINS[name]))
        elif name == "SeniorCitizen":
            specs.append(ColumnSpec(name, "int", isin=(0, 1)))
        elif name == "tenure":
            specs.append(ColumnSpec(name, "int", ge=0, le=tenure_max))
        elif name == "MonthlyCharges":
            specs.append(ColumnSpec(name, "double", gt=0.0, le=monthly_max))
        elif name == "TotalCharges":
            specs.append(ColumnSpec(name, "double", nullable=total_nullable, ge=0.0))
    return specs


RAW_CONTRACT = Contract(
    "raw", tuple([ColumnSpec("customerID", "string", unique=True), *_feature_specs(72, True),
                  ColumnSpec("Churn", "string", isin=BINARY)]),
    strict=True, coerce=True, key=("customerID",))

PROCESSED_CONTRACT = Contract(
    "processed", tuple([*_feature_specs(72, False), ColumnSpec(TARGET, "int", isin=(0, 1))]),
    strict=True, coerce=False)

# Scoring input: a different, public contract (tenure up to 100, charges up to 200, total
# may be missing); unknown extra fields are ignored.
SCORING_CONTRACT = Contract(
    "scoring", tuple(_feature_specs(100, True, 200.0)), strict=False, coerce=False)


def raw_schema() -> StructType:
    """All columns read as text; typing is the contract's try_cast, never inferSchema."""
    return StructType([StructField(c, StringType(), True) for c in RAW_ORDER])


def load_raw(spark: SparkSession, path: str) -> DataFrame:
    """A1: header CSV -> typed, validated frame. The contract sees the text: a number that
    does not parse, a value outside its domain or a repeated id raises ContractError with
    every broken rule (a blank TotalCharges is NULL, which the contract allows)."""
    return validate(spark.read.schema(raw_schema()).option("header", True).csv(path), RAW_CONTRACT)


def _filled(df: DataFrame, **kw) -> DataFrame:
    """The one expression that training (C1) and scoring (C2) share."""
    return fill_and_label(df, {"TotalCharges": 0.0}, **kw)


def preprocess(df: DataFrame) -> DataFrame:
    """Drop the id, TotalCharges NULL -> 0.0, churn = (Churn == 'Yes') as int; the result
    must meet the processed contract."""
    return validate(_filled(df, label_src="Churn", label=TARGET, drop=["customerID"]), PROCESSED_CONTRACT)


def preprocess_scoring(df: DataFrame) -> DataFrame:
    """The same fill for label-less records."""
    return _filled(df)
