"""Every registered query of the reference's operators against its SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from thylakoid.plans import catalog

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows(frame):
    blank = lambda v: None if pd.isna(v) else v
    number = lambda v: int(v) if isinstance(v, float) and math.isfinite(v) and v == int(v) else v
    columns = sorted(frame.columns)
    return sorted(str([number(blank(v)) for v in r]) for r in frame[columns].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_against_sql(spark, tables, name):
    ours = catalog.QUERIES[name](spark, SMALL).toPandas()
    theirs = tables.sql(catalog.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_all_but_rotations_have_sql():
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"circular_rotation"}


def test_rotations(spark):
    """Every document's sequence comes back turned by its rule, which fits; those that fit nowhere come back as they were."""
    anchor, most = 16, 3
    pairs = {r.doc_id: r for r in catalog._neighbours(spark, SMALL).collect()}
    got = catalog.QUERIES["circular_rotation"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(pairs)
    wrong = lambda text, pattern: sum(x != y and "N" not in (x, y) for x, y in zip(text, pattern))
    back = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    fits = 0
    for r in got:
        ref, query = pairs[r.doc_id].a, pairs[r.doc_id].b
        turned = query if r.orientation == "fwd" else back(query)
        assert r.seq == turned[r.cut :] + turned[: r.cut]
        places = range(len(query)) if len(ref) >= anchor and query else []
        two = {o: 2 * t for o, t in (("fwd", query), ("rev", back(query)))}
        holds = lambda o, i, pattern: i + len(pattern) <= len(two[o]) and wrong(two[o][i : i + len(pattern)], pattern) <= most
        if r.rule is None:
            assert r.cut == 0 and not any(holds(o, i, ref[:anchor]) for o in two for i in places)
            continue
        fits += 1
        if r.rule == "head":
            assert r.cut == 0
        elif r.rule == "circle":
            assert holds(r.orientation, (r.cut - anchor) % len(query), ref[-anchor:] + ref[:anchor])
        else:
            assert holds(r.orientation, r.cut, ref[:anchor]) and not any(holds(r.orientation, i, ref[:anchor]) for i in range(r.cut))
    assert fits > 5


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
