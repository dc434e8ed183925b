import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from claimlens import schemas  # noqa: E402
from claimlens.session import configure  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


def frame(spark, name, rows):
    """A table from dicts; absent columns are null."""
    schema = schemas.TABLES[name]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


DETAIL = (
    '{"edi_source":"837","clearinghouse_id":"CH1","line_items":[{"line":1,"cpt":"99213","cpt_desc":"d","units":1,'
    '"charge":10.5,"modifiers":["25","LT"],"dx_pointers":["I10"],"rev_code":"0450"}],"adjudication":'
    '{"coordination_of_benefits":true,"cob_payer":"Medicare","copay":5.25,"coinsurance":0.1,'
    '"deductible_applied":1.0,"edits_triggered":["MUE"]}}'
)


def claim(n, **changes):
    row = {
        "claim_id": f"C{n}",
        "member_id": "M1",
        "provider_id": "P1",
        "claim_type": "837P Professional",
        "status": "Paid",
        "billed_amount": 100.0,
        "allowed_amount": 80.0,
        "paid_amount": 80.0,
        "place_of_service": "11",
        "pos_desc": "Office",
        "primary_cpt": "99213",
        "primary_dx": "I10",
        "requires_manual_review": 0,
        "claim_detail": DETAIL,
    }
    return {**row, **changes}


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
