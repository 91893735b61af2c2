from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loomtext.session import local_session

    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


FAQ_ROWS = [
    ("FAQ-01", "Money", "How is the bursar fee deposit paid?", "Send the wire to the bursar office before May."),
    ("FAQ-02", "Parking", "Where are automobile permits sold?", "The motor office sells automobile storage permits."),
    ("FAQ-03", "Banking", "Which commercial bank handles wire transfers?", "First State bank handles tuition transfers."),
    ("FAQ-04", "Outdoors", "May students fish on the river bank?", "Fishing on the river bank needs a state licence."),
    ("FAQ-05", "Visa", "Who signs F-1 visa forms?", "The scholar desk signs F-1 forms, on 2 days a week."),
    ("FAQ-06", "Café", "Quand ouvre le café?", "Le café ouvre à midi."),
    ("FAQ-07", "Empty", None, None),
]


@pytest.fixture(scope="session")
def faq(spark):
    from loomtext import schemas
    from loomtext.operators.prepare import with_full_text
    from loomtext.sources.records import inline_records

    rows = inline_records(spark, FAQ_ROWS, schemas.FAQ)
    return with_full_text(rows).selectExpr("faq_id AS doc_id", "category", "full_text AS text")


@pytest.fixture
def ask(spark):
    def make(*texts):
        rows = [(i, t) for i, t in enumerate(texts, 1)]
        return spark.createDataFrame(rows, "query_id long, text string")

    return make
