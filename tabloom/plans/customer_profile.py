"""The customer table the jobs run on, derived from customers and their orders.

It has the shape the cleaning and feature rules are written for: text flags,
blank numbers, missing categories, copies of rows and zero tenures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The column names of the customer table.
COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService", "MultipleLines",
    "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn",
]
SCHEMA = ", ".join(
    f"{c} " + {"SeniorCitizen": "int", "tenure": "int", "MonthlyCharges": "double"}.get(c, "string") for c in COLUMNS
)
# Payment method per market segment; the fifth segment has none.
PAYMENT_METHODS = {
    "AUTOMOBILE": "Electronic check",
    "BUILDING": "Mailed check",
    "FURNITURE": "Bank transfer (automatic)",
    "HOUSEHOLD": "Credit card (automatic)",
}


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with orders; every fiftieth customer appears twice."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")

    habits = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.count("*").alias("n"),
        F.max((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("urgent"),
    )
    key, n = F.col("c_custkey"), F.col("n")
    months = F.expr("(year(last_order) * 12 + month(last_order)) - (year(first_order) * 12 + month(first_order))")
    base = (
        customers.join(habits, "c_custkey")
        .withColumn("tenure", F.floor(F.greatest(F.lit(0), months - 36) * 7 / F.lit(4.0)).cast("int"))
        .withColumn("cents", 1825 + F.floor((F.col("c_acctbal") + 1000) * 100 / 110).cast("bigint"))
        .withColumn("net", F.col("c_nationkey") % 3)
    )

    def yes_if(test):
        return F.when(test, "Yes").otherwise("No")

    def add_on(test):
        return F.when(F.col("net") == 0, "No internet service").when(test, "Yes").otherwise("No")

    payment = F.lit(None).cast("string")
    for segment, method in PAYMENT_METHODS.items():
        payment = F.when(F.col("c_mktsegment") == segment, method).otherwise(payment)
    charged = (F.col("tenure") * F.col("cents")).cast("double") / F.lit(100.0)

    values = {
        "customerID": F.col("c_name"),
        "gender": F.when(key % 2 == 0, "Male").otherwise("Female"),
        "SeniorCitizen": (F.col("c_acctbal") < 0).cast("int"),
        "Partner": F.when(key % 3 == 0, "yes").otherwise("No"),
        "Dependents": yes_if(n % 3 == 0),
        "tenure": F.col("tenure"),
        "PhoneService": yes_if(F.col("urgent") == 1),
        "MultipleLines": F.when(F.col("urgent") == 0, "No phone service").otherwise(yes_if(key % 2 == 0)),
        "InternetService": F.when(F.col("net") == 0, "No").when(F.col("net") == 1, "DSL").otherwise("Fiber optic"),
        "OnlineSecurity": add_on(key % 7 < 2),
        "OnlineBackup": add_on(key % 7 < 3),
        "DeviceProtection": add_on(key % 11 < 4),
        "TechSupport": add_on(n % 2 == 0),
        "StreamingTV": add_on(key % 5 < 2),
        "StreamingMovies": add_on(key % 13 < 6),
        "Contract": F.when(n <= 8, "Month-to-month").when(n <= 12, "One year").otherwise("Two year"),
        "PaperlessBilling": yes_if(key % 17 < 10),
        "PaymentMethod": payment,
        "MonthlyCharges": F.col("cents").cast("double") / F.lit(100.0),
        "TotalCharges": F.when(F.col("tenure") == 0, " ").otherwise(
            F.round(charged, 2).cast("decimal(18,2)").cast("string")
        ),
        "Churn": yes_if(F.col("last_order") < F.lit("2001-02-01").cast("timestamp_ntz")),
    }
    copies = F.when(key % 50 == 7, 2).otherwise(1)
    return base.select(
        *[values[c].alias(c) for c in COLUMNS], F.explode(F.sequence(F.lit(1), copies)).alias("_copy")
    ).select(*COLUMNS)
