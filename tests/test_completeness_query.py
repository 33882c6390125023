import datetime
from pathlib import Path

import duckdb
import pytest

from inkmill import queries
from inkmill.operators.scoring import RUBRICS

DATA = Path("/root/testdata/sf0.001")


def test_each_record_is_held_against_the_rubric_of_its_scores(spark, tmp_path):
    at = datetime.datetime(2026, 1, 1)
    given = lambda name, n: {f"{name}.{m}": 0.5 if k < n else None for k, m in enumerate(RUBRICS[name])}
    rows = [(f"{name}-{n}", top, given(name, n), at) for name in RUBRICS for n in (6, 7) for top in ["Memoir"]]
    rows += [("none", "poetry", None, at), ("empty", "poetry", {}, at), ("spelled", "Story-Horror", given("narrative_creative", 10), at)]
    schema = "id string, top string, scores map<string,double>, ingested_at timestamp"
    spark.createDataFrame(rows, schema).selectExpr("id", "named_struct('top', top, 'sub', null) as classification", "scores", "ingested_at").write.parquet(f"{tmp_path}/records.parquet")
    found = {r["id"] for r in queries.queries()["completeness_filter"](spark, str(tmp_path)).collect()}
    assert found == {f"{name}-7" for name in RUBRICS} | {"spelled"}


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_counts_by_own_rubric(spark):
    own = f"""SELECT DISTINCT id FROM (SELECT id, split_part(e.key, '.', 1) AS rubric, count(e.value) AS n
        FROM (SELECT * FROM '{DATA}/records.parquet' WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at) = 1), unnest(map_entries(scores)) AS u(e) GROUP BY 1, 2) WHERE n / 10.0 >= 0.7"""
    expected = {r[0] for r in duckdb.sql(own).fetchall()}
    assert {r["id"] for r in queries.queries()["completeness_filter"](spark, str(DATA)).collect()} == expected
