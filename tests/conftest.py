import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sievestream.schemas import RULE_DDL  # noqa: E402
from sievestream.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def make_rules(spark):
    def make(*rules: dict):
        return spark.createDataFrame([{k: str(v) for k, v in r.items() if v is not None} for r in rules], RULE_DDL)

    return make


@pytest.fixture
def make_lines(spark):
    """Messages (dicts or raw text) as the lines frame the operators take."""

    def make(*messages):
        rows = [(m if isinstance(m, str) else json.dumps(m), f"{i:04d}") for i, m in enumerate(messages)]
        return spark.createDataFrame(rows, "value STRING, row_id STRING").selectExpr(
            "*", "timestamp'2024-01-01 00:00:00' AS ingest_ts"
        )

    return make
