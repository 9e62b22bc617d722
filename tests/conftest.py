import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chunkwise.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def _person(i: int) -> dict:
    """The i-th invented person record (camelCase id, all fields valid)."""
    return {"personId": f"person{i:03d}", "sex": ("female", "male")[i % 2], "age": 20.25 + 7 * i,
            "pclass": i % 3 + 1, "sibsp": i % 4, "parch": (2 * i) % 5, "fare": 12.5 + 10 * i,
            "embarked": "scq"[i % 3]}


PERSONS = [_person(i) for i in range(5)]
