import os
import subprocess
import sys

import duckdb

import __spark_entry__ as E

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "prix_moyen_eur" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 40


def _norm(v):
    if isinstance(v, float):
        return repr(v)                      # exact, as a value hash would be
    return v.isoformat() if hasattr(v, "isoformat") else v


def test_queries_match_oracle_on_smallest_scale(query_frame):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    failures = []
    for name, sql in E.oracle_sql().items():
        df = query_frame(name)
        cols = sorted(df.columns)
        a = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
        cur = con.execute(sql)
        dcols = [d[0] for d in cur.description]
        idx = [dcols.index(c) for c in cols] if sorted(dcols) == cols else None
        if idx is None:
            failures.append((name, "columns", dcols))
            continue
        b = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
        if a != b:
            failures.append((name, len(a), len(b)))
    assert not failures, failures


def test_entry_survives_a_missing_module_of_the_optional_part():
    """Without a third-party module that only the training-data operators need, all other queries are there."""
    code = ("import sys; sys.modules['ahocorasick'] = None\n"
            "import __spark_entry__ as E; q = E.queries(); print(len(q), sorted(n for n in q if n.startswith('op') or n == 'pipeline'))")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120).stdout.split(" ", 1)
    assert int(out[0]) >= 110 and out[1].strip() == "[]"
