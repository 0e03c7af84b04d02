"""Typed, renamed forms of landed tables."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Landed code and staged name of each measure.
MEASURES = {
    "ASSET": "total_assets",
    "DEP": "total_deposits",
    "EQ": "equity",
    "EQR": "equity_ratio_pct",
    "NETINC": "net_income",
    "ROA": "roa_pct",
    "ROE": "roe_pct",
    "NIMY": "net_interest_margin_pct",
    "EEFFR": "efficiency_ratio_pct",
    "LNLSNET": "net_loans_leases",
    "SC": "securities",
    "NPERFV": "nonperforming_assets_ratio_pct",
    "NCLNLS": "noncurrent_loans",
    "NCLNLSR": "noncurrent_loans_ratio_pct",
    "BRO": "brokered_deposits",
    "DEPUNA": "uninsured_deposits",
    "DEPUNINS": "uninsured_deposits_est",
    "NONII": "noninterest_income",
    "NONIIR": "noninterest_income_ratio_pct",
    "NTLNLS": "net_chargeoffs",
    "NTLNLSCOR": "net_chargeoffs_ratio_pct",
    "INTEXPY": "cost_of_funds_pct",
    "RBCT1CER": "cet1_ratio_pct",
    "RBCRWAJ": "total_rbc_ratio_pct",
    "RBC1AAJ": "leverage_ratio_pct",
}


def stage_financials(raw: DataFrame, as_of: date | None = None) -> DataFrame:
    """Strict casts: junk fails the query. ``as_of`` cuts later periods a second time."""
    out = raw.select(F.col("CERT").cast("bigint").alias("cert"), F.to_date(F.col("REPDTE").cast("string"), "yyyyMMdd").alias("report_date"), *[F.col(c).cast("double").alias(n) for c, n in MEASURES.items()])
    return out.filter(F.col("report_date") <= F.lit(as_of)) if as_of else out


def stage_institutions(raw: DataFrame) -> DataFrame:
    """Registry; one- or two-digit months and days parse, an active flag of 1 is true."""
    date_of = lambda c: F.to_date(F.col(c), "M/d/yyyy")
    return raw.select(
        F.col("CERT").cast("bigint").alias("cert"),
        F.col("NAME").alias("bank_name"),
        F.col("CITY").alias("city"),
        F.col("STALP").alias("state_code"),
        F.col("STNAME").alias("state_name"),
        F.col("BKCLASS").alias("bank_class"),
        (F.col("ACTIVE").cast("int") == 1).alias("is_active"),
        date_of("ESTYMD").alias("established_date"),
        date_of("ENDEFYMD").alias("end_of_existence_date"),
        F.col("WEBADDR").alias("website"),
        F.col("ASSET").cast("double").alias("current_assets"),
        F.col("DEP").cast("double").alias("current_deposits"),
    )


def stage_failures(raw: DataFrame) -> DataFrame:
    """Lenient key: a failure without a usable number stays, with a null one."""
    return raw.select(
        F.col("ID").cast("bigint").alias("failure_id"),
        F.col("CERT").try_cast("bigint").alias("cert"),
        F.col("NAME").alias("bank_name"),
        F.to_date("FAILDATE", "M/d/yyyy").alias("failure_date"),
        F.col("RESTYPE").alias("resolution_type"),
        F.col("QBFASSET").cast("double").alias("assets_at_failure"),
    )


def stage_weekly(raw: DataFrame) -> DataFrame:
    """Observations as numbers; a dot or other text means missing and is dropped."""
    out = raw.select("series_id", "series_title", F.to_date("obs_date").alias("obs_date"), F.col("value").try_cast("double").alias("value"))
    return out.filter(F.col("value").isNotNull())


def except_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)
