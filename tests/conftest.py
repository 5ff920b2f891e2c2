import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from checks.session import session

    return session("4")


POSTINGS = [
    (0, "Head Pastry Baker", "Our bakery wants a baker who knows sourdough bread and croissants, orders flour and trains "
        "apprentices. Early morning shifts."),
    (1, "Bread Line Supervisor", "Supervise a bread line in a factory: ovens, flour stock, hygiene checks and morning "
        "shifts for twelve workers."),
    (2, "Harbour Crane Operator", "Operates cranes at a container harbour, loading ships and checking cables, in shifts "
        "and any weather."),
    (3, "Sourdough Baker", "Small shop seeks a sourdough baker. You mix dough, shape loaves, fire the ovens and sell "
        "bread to neighbours."),
    (4, "Ship Cook", "Cook meals for a crew of ten on a cargo ship, order supplies and keep the galley clean. Harbour "
        "leave monthly."),
]


@pytest.fixture(scope="session")
def five(spark):
    return spark.createDataFrame(POSTINGS, "doc_id bigint, title string, description string")


@pytest.fixture(scope="session")
def five_index(five):
    from matchlake.functions.fixed import JOB_FIELDS
    from matchlake.operators.lexical import build_index

    return build_index(five, JOB_FIELDS, five.select("doc_id", "title"))


@pytest.fixture(scope="session")
def sample_queries(spark):
    rows = [(1, "sourdough baker bread ovens"), (2, "harbour crane container"),
            (3, "galley supplies clean"), (4, "bread bread flour"), (5, "the of"), (6, ""), (7, "zzz")]
    return spark.createDataFrame(rows, "query_id bigint, text string")
