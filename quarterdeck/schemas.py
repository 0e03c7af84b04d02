"""Schemas of landed tables."""

from pyspark.sql.types import ArrayType, DataType, DateType, DoubleType, LongType, StringType, StructField, StructType

TEXT, NUMBER, REAL, DATE = StringType(), LongType(), DoubleType(), DateType()


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def texts(names: str) -> StructType:
    return struct(**{name: TEXT for name in names.split()})


FINANCIALS = texts(
    "CERT REPDTE ASSET DEP EQ EQR NETINC ROA ROE NIMY EEFFR LNLSNET SC NPERFV NCLNLS NCLNLSR BRO DEPUNA DEPUNINS NONII NONIIR NTLNLS NTLNLSCOR INTEXPY RBCT1CER RBCRWAJ RBC1AAJ"
)
INSTITUTIONS = texts("CERT NAME CITY STALP STNAME ZIP ACTIVE BKCLASS ESTYMD ENDEFYMD CHANGEC1 FED_RSSD WEBADDR DATEUPDT ASSET DEP")
FAILURES = texts("ID CERT NAME FAILDATE FAILYR RESTYPE RESTYPE1 CITYST QBFASSET QBFDEP SAVR CHCLASS1")
WEEKLY = texts("series_id series_title obs_date value")
EVENTS = struct(
    event_date=TEXT,
    event_timestamp=NUMBER,
    event_name=TEXT,
    user_pseudo_id=TEXT,
    user_first_touch_timestamp=NUMBER,
    platform=TEXT,
    event_params=ArrayType(struct(key=TEXT, value=struct(string_value=TEXT, int_value=NUMBER, float_value=REAL, double_value=REAL))),
    device=struct(category=TEXT, operating_system=TEXT, web_info=texts("browser")),
    geo=texts("country region city"),
    traffic_source=texts("source medium name"),
    ecommerce=struct(purchase_revenue_in_usd=REAL, transaction_id=TEXT),
)
ENVELOPE = "request struct<endpoint: string, params: map<string, string>>, response struct<meta: struct<total: bigint>, data: array<struct<data: {fields}>>>"
