"""Fixed table schemas (one StructType per logical table; never inferred).

Every base field of the raw feeds is a string, as in the source system;
numbers are parsed once, in ``operators.charges.charge_table``.
"""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


PATIENT_CLAIM = _strings("date", "patient_id", "claim_id")
PATIENT = _strings("id", "age", "gender", "income")

_PROVIDER_COLUMNS = ("provider_id", "provider_name", "provider_address", "provider_city",
                     "provider_state", "provider_zipcode", "referral_region")
INPATIENT = _strings("drg", *_PROVIDER_COLUMNS, "total_discharges",
                     "average_covered_charges", "average_total_payments")
OUTPATIENT = _strings("apc", *_PROVIDER_COLUMNS, "outpatient_services",
                      "average_est_submitted_charges", "average_total_payments")

CHARGES = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in (
        "type", "procedure_id", "provider_id", "provider_city", "provider_state",
        "provider_zipcode", "referral_region")]
    + [T.StructField(n, T.DoubleType(), True) for n in (
        "total_charges", "avg_charged_amount", "avg_total_payment")]
)

PROCEDURE = _strings("id", "type", "full_name")
REVIEW = _strings("patient_id")

CLAIM_COUNT = T.StructType([
    T.StructField("claim_id", T.StringType(), True),
    T.StructField("n", T.LongType(), True),
])

PATIENT_FEATURES = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("review", T.IntegerType(), False),
    T.StructField("age", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("income", T.StringType(), True),
    T.StructField("type_I", T.LongType(), True),
    T.StructField("type_O", T.LongType(), True),
    T.StructField("claims", T.ArrayType(CLAIM_COUNT, False), True),
])

# Names of the raw tag fields in the patient XML feed, mapped to columns.
# Fixed values of the feed format.
PATIENT_XML_FIELDS = {"id": "id", "age": "age", "gndr": "gender", "inc": "income"}
