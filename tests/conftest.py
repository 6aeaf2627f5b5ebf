import os
import sys
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from filingscope.session import local_session  # noqa: E402

HISTORY = (
    "sec_number string, filing_date date, raum decimal(20,2), client_count int, account_count int, "
    "cco_name string, disciplinary_disclosures int"
)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def history(spark):
    """Build a history of one firm or more from (firm, day, raum, clients, accounts, officer, disclosures)."""

    def build(*rows):
        return spark.createDataFrame([filing(*row) for row in rows], HISTORY)

    return build


def filing(firm, day, raum, clients=10, accounts=10, officer="A", disclosures=0):
    amount = None if raum is None else Decimal(str(raum))
    return (firm, date.fromisoformat(day), amount, clients, accounts, officer, disclosures)
