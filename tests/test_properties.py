"""Property tests: write→parse round trip, J1 keeps the row count, the
crosswalk is a bijection.  Few examples each: every example runs Spark."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixreg.operators import crosswalk, lookup_join
from fixreg.sources.fixed_width import read_fixed_width
from fixreg.sources.layout import ColumnSpec, Layout

from registerfiles import render, write_latin1

LAY = Layout("Dec_prop", (
    ColumnSpec("code", 1, 6, "string"),
    ColumnSpec("n", 7, 6, "bigint"),
    ColumnSpec("tekst", 13, 12, "string"),
))
LATIN1 = st.characters(min_codepoint=33, max_codepoint=255, blacklist_characters="\x7f")
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.text(LATIN1, min_size=1, max_size=6), st.integers(0, 999999),
                          st.text(LATIN1, min_size=0, max_size=12)), min_size=1, max_size=20))
def test_write_parse_round_trip(spark, tmp_path_factory, rows):
    d = tmp_path_factory.mktemp("rt")
    lines = render(LAY, [{"code": c, "n": n, "tekst": t} for c, n, t in rows])
    path = write_latin1(os.path.join(d, "Dec_prop.asc"), lines)
    got = sorted((r["code"], r["n"], r["tekst"]) for r in read_fixed_width(spark, path, LAY).collect())
    want = sorted((c, n, t.strip(" \t\r\n") or None) for c, n, t in rows)
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 5)), min_size=0, max_size=30),
       st.lists(st.one_of(st.none(), st.integers(0, 8)), min_size=0, max_size=10, unique=True))
def test_lookup_join_keeps_row_count(spark, left_keys, right_keys):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(left_keys)], "k int, i int")
    right = spark.createDataFrame([(k, f"v{k}") for k in right_keys], "k int, v string")
    out = lookup_join(left, right, ["k"]).collect()
    assert len(out) == len(left_keys)
    assert all(r["v"] == (f"v{r['k']}" if r["k"] in right_keys else None) for r in out)


@SETTINGS
@given(st.sets(st.integers(0, 10**9), min_size=1, max_size=40), st.text(min_size=1, max_size=8))
def test_crosswalk_bijection(spark, ids, salt):
    df = spark.createDataFrame([(str(i).zfill(12),) for i in ids], "PersoonsgebondenNummer string")
    rows = crosswalk(df, salt=salt).collect()
    old = [r[0] for r in rows]
    new = [r[1] for r in rows]
    assert sorted(old) == sorted(new) == sorted(str(i).zfill(12) for i in ids)
