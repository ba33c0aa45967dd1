"""Every query that has SQL must give the rows that DuckDB gives."""

import duckdb
import pytest

import __spark_entry__ as entry
from brindle import plans

from .conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def comparable(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    show = lambda v: "" if v is None else repr(0.0 if v == 0 else float(v)) if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    assert len(set(df.columns)) == len(df.columns)
    if name not in entry.oracle_sql():
        assert got
        return
    found = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert comparable(got, df.columns) == comparable(found.fetchall(), names)


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def test_nothing_else_imports_the_optional_subpackage():
    import pathlib

    root = pathlib.Path(plans.__file__).parent.parent
    for path in root.rglob("*.py"):
        if path.parent.name != "llm":
            assert "llm" not in path.read_text(), path


@pytest.mark.parametrize("missing", ["zstandard", "corpus_pipeline"])
def test_other_queries_stay_where_an_optional_part_cannot_be_imported(missing):
    import subprocess
    import sys

    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; n = e.queries(); assert 'paired_outcome' in n and 'pipeline' not in n and e.oracle_sql(), n"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=str(__import__("pathlib").Path(entry.__file__).parent))
