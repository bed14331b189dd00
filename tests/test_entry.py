import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    from sievestream.plans.catalog import QUERIES
    from sievestream.plans.oracle import ORACLE

    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("also", [[], ["corpus_pipeline.py"]])
def test_entry_without_the_optional_subpackage(tmp_path, also):
    """The rest imports and keeps its queries when the training-data operators (and their pipeline) are deleted."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__", "llm", *also)])
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    from sievestream.plans.catalog import QUERIES

    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == sorted(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not here")
def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "created_at_iso", "n_rules", "first_value", "rule_tag"]
    assert df.count() == 200


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not here")
def test_queries_agree_with_their_sql(spark):
    """A few of all kinds; `tools/check_oracle.py` runs them all."""
    import duckdb

    from tools.check_oracle import compare

    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{file}'")
    for name in ("match_keyword", "rule_union", "rate_limit", "validate_geo_legacy", "limit_counter"):
        assert compare(spark, con, SMALL, name)[0].startswith("ok"), name
