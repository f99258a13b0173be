import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimlens.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", shuffle_partitions=4, driver_memory="4g")
    yield s
    s.stop()


CHARGE_COLS = ("type procedure_id provider_id provider_city provider_state provider_zipcode "
               "referral_region total_charges avg_charged_amount avg_total_payment").split()


@pytest.fixture
def charges_df(spark):
    """Build a typed charge table from short tuples:
    (type, procedure_id, provider_id, region, count, charged, paid)."""
    def make(rows):
        full = [(t, p, prov, "City", "ST", "00000", reg, n, x, y)
                for (t, p, prov, reg, n, x, y) in rows]
        schema = ("type string, procedure_id string, provider_id string, provider_city string, "
                  "provider_state string, provider_zipcode string, referral_region string, "
                  "total_charges double, avg_charged_amount double, avg_total_payment double")
        return spark.createDataFrame(full, schema)
    return make
