import os
import shutil
import subprocess
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from phylospark import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows_of(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(r[i] for i in order) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query_equals_its_sql(spark, duck, name):
    frame = plans.queries()[name](spark, SF)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    assert got[1], "no rows"
    sql = plans.oracle_sql().get(name)
    if sql:
        out = duck.execute(sql)
        want = rows_of([d[0] for d in out.description], out.fetchall())
        assert got[0] == want[0]
        assert len(got[1]) == len(want[1])
        for a, b in zip(got[1], want[1]):
            assert a == b


def test_the_rest_works_without_the_llm_folder(tmp_path):
    """Without the folders of training-data operators, with and without the pipeline's file."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import __spark_entry__ as e
from pyspark.sql import SparkSession
print(len(e.queries()), len(e.oracle_sql()), [k for k in e.queries() if k == 'pipeline' or k[:2] == 'op' and k[2].isdigit()])
spark = SparkSession.builder.master('local[4]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '4').getOrCreate()
print(e.entry(spark).count() > 0, *[e.queries()[k](spark, '{SF}').count() > 0 for k in ('locus_metrics', 'best_gene', 'gff_file')])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": ""}
    for gone in ({"llm"}, {"llm", "corpus_pipeline.py"}):
        copy = tmp_path / f"repo{len(gone)}"
        shutil.copytree(root, copy, ignore=lambda _, names, gone=gone: {n for n in names if n in (".git", "__pycache__", *gone)})
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, check=True).stdout
        assert out.split() == [str(len(plans.queries())), str(len(plans.oracle_sql())), "[]", *["True"] * 4]
