"""Every registered query of the library against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from altiplano.plans import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    rows = df.collect()
    assert len(set(df.columns)) == len(df.columns)
    if name not in queries.SQL:
        assert rows
        return
    got = con.execute(queries.SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(x) for x in sorted(names)]
    mine = sorted((tuple(r[x] for x in sorted(names)) for r in rows), key=repr)
    assert mine == sorted((tuple(r[i] for i in at) for r in got.fetchall()), key=repr)


def test_entry_works_without_the_training_data_operators(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), any(k.startswith('op') for k in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.returncode == 0, out.stderr
    n, sql, any_op = out.stdout.split()
    assert int(n) >= 60 and int(sql) >= 58 and any_op == "False"


@pytest.mark.parametrize("name", ["gcp_mesh", "virtual_matches", "corresponding_roi", "geodesic_box"])
def test_regions_take_every_rectangle(spark, name):
    sf = "/root/testdata/sf0.01"
    c = duckdb.connect()
    c.execute(f"CREATE VIEW part AS SELECT * FROM '{sf}/part.parquet'")
    df = queries.QUERIES[name](spark, sf)
    got = c.execute(queries.SQL[name])
    at = [[d[0] for d in got.description].index(x) for x in df.columns]
    mine = sorted(map(tuple, df.collect()))
    assert mine == sorted(tuple(r[i] for i in at) for r in got.fetchall())
    assert len({r[df.columns.index("rid")] for r in mine}) == c.execute("SELECT count(DISTINCT p_partkey) FROM part").fetchone()[0] > 200


def test_border_mask_takes_the_whole_raster(spark):
    c = duckdb.connect()
    c.execute("CREATE VIEW events AS SELECT * FROM '/root/testdata/sf0.1/events.parquet'")
    got = c.execute(queries.SQL["border_mask"]).fetchall()
    assert sorted(map(tuple, queries.QUERIES["border_mask"](spark, "/root/testdata/sf0.1").select("id", "ok").collect())) == sorted(got)
    assert len(got) > 10_000 and any(ok for i, ok in got if i >= 10_000)


def test_small_components_take_the_whole_raster(spark):
    from altiplano.plans import carriers

    sf = "/root/testdata/sf0.1"  # 1,000 rows: regions that cross blocks
    v = {(r.row, r.col): r.v for r in carriers.raster(spark, sf).collect()}
    up = {p: p for p in v}

    def root(p):
        while up[p] != p:
            up[p] = p = up[up[p]]
        return p

    for (y, x), z in v.items():
        for q in ((y + 1, x), (y, x + 1)):
            if z is not None and v.get(q) is not None and abs(z - v[q]) <= 20:
                up[root((y, x))] = root(q)
    n = {}
    for p in v:
        n[root(p)] = n.get(root(p), 0) + 1
    want = sorted((y * 100 + x, z if z is not None and n[root((y, x))] >= 8 else None) for (y, x), z in v.items())
    assert sorted(map(tuple, queries.QUERIES["small_components"](spark, sf).collect())) == want


def test_pointing_and_neighbors_take_all_matches(spark):
    import numpy as np

    from altiplano.plans import carriers

    sf = "/root/testdata/sf0.1"
    m = carriers.matches(spark, sf).toPandas()
    m["pair"], m["k"] = m.match_id % 13, m.match_id // 13 % 4
    m["dx"], m["dy"] = m.x2 - m.x1, m.y2 - m.y1
    at = m.groupby(["pair", "tile", "k"])[["x2", "y2", "dx", "dy"]].mean().reset_index()
    got = {r.pair: r for r in queries.QUERIES["pointing_global_all"](spark, sf).collect()}
    assert sorted(got) == sorted(at.pair.unique())
    for pair, g in at.groupby("pair"):
        assert len(g) >= 3
        one = np.column_stack([g.x2, g.y2, np.ones(len(g))])
        want = np.linalg.lstsq(one, np.column_stack([g.x2 - g.dx, g.y2 - g.dy]), rcond=None)[0].T
        mine = np.array([[got[pair][f"a{i}{j}"] for j in range(3)] for i in range(2)])
        assert np.abs(one @ want.T - one @ mine.T).max() < 0.02

    c = duckdb.connect()
    c.execute(f"CREATE VIEW orders AS SELECT * FROM '{sf}/orders.parquet'")
    df = queries.QUERIES["neighbor_matches_ellipse"](spark, sf)
    rows = df.select("ix", "iy", "n", "mx1").collect()
    assert sorted(map(tuple, rows)) == sorted(c.execute(queries.SQL["neighbor_matches_ellipse"]).fetchall())
    assert sum(r.n for r in rows) >= len(m) and max(r.ix for r in rows) > 2


def test_large_values_are_rounded_as_in_sql(spark, tmp_path):
    c = duckdb.connect()
    c.execute(f"CREATE TABLE orders AS SELECT * REPLACE (o_custkey + 4000000000 AS o_custkey) FROM '{SF}/orders.parquet'")
    c.execute(f"COPY orders TO '{tmp_path}/orders.parquet'")
    for name in ("point_line_distance", "apply_homography", "epipolar_error_vectors"):
        got = queries.QUERIES[name](spark, str(tmp_path)).collect()
        assert sorted(map(tuple, got)) == sorted(c.execute(queries.SQL[name]).fetchall())
