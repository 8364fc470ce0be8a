from __future__ import annotations

import os
import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare
from lakeloom.plans.oracles import ORACLES
from lakeloom.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")


def test_entry(spark):
    assert entry(spark).count() == 200


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_queries_leave_nothing_in_the_catalog(spark):
    def catalog():
        return (
            [d.name for d in spark.catalog.listDatabases()],
            sorted(t.name for t in spark.catalog.listTables()),
            spark.sparkContext._jsc.sc().getPersistentRDDs().size(),
        )

    before = catalog()
    for name in ("catalog_overwrite", "table_swap", "flight_classes_view", "airport_roles_kept", "lake_passengers"):
        assert QUERIES[name](spark, SMALL).count() > 0
    assert catalog() == before


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    verdict = compare(spark, SMALL, [name])[name]
    assert verdict.split()[0] in ("ok", "rows"), verdict
    assert ":" not in verdict, f"types differ: {verdict}"


@pytest.mark.parametrize("missing", ["regex", "public_tokenizers", "lakeloom.llm.queries", "corpus_pipeline"])
def test_other_queries_load_whatever_the_training_data_operators_lack(missing):
    code = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__
from lakeloom.plans.queries import QUERIES
assert set(__spark_entry__.queries()) == set(QUERIES) and len(QUERIES) > 50
assert set(__spark_entry__.oracle_sql()) <= set(QUERIES)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_statistics_of_many_files_sum_up_to_those_of_the_table(spark, tmp_path):
    lineitem = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    lineitem.repartition(5).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = QUERIES["file_stats"](spark, str(tmp_path)).collect()
    assert len({r.file_name for r in found}) == len(found) == 5
    whole = QUERIES["file_stats"](spark, SMALL).first()
    assert sum(r.num_records for r in found) == whole.num_records
    assert min(r.min_l_shipdate for r in found) == whole.min_l_shipdate
    assert max(r.max_l_returnflag for r in found) == whole.max_l_returnflag
