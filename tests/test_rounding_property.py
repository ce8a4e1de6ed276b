"""round_half_up agrees with decimal rounding in DuckDB on random doubles
within the range where the double has digits at the rounding position."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelyze.functions.numeric import round_half_up

magnitudes = st.sampled_from([1e-3, 1.0, 1e2, 1e4, 1e6, 1e9, 1e12])
values = st.lists(st.floats(-1, 1, allow_nan=False), min_size=20, max_size=200)


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, mag=magnitudes, scale=st.sampled_from([0, 2, 4, 8]))
def test_round_half_up_matches_decimal_rounding(spark, vals, mag, scale):
    xs = [v * mag for v in vals] + [1.005, -2.675, 0.125, 2.5, -0.5]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = {r.i: r.r for r in df.select("i", round_half_up("x", scale).alias("r")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(xs)))
    want = dict(
        con.execute(
            f"SELECT i, CAST(ROUND(CAST(x AS DECIMAL(38,{scale + 7})), {scale}) AS DOUBLE) FROM t"
        ).fetchall()
    )
    # Exact agreement wherever a double still has digits at that position
    # (beyond it both engines round floating-point noise).
    limit = 9e15 / 10.0 ** (scale + 7)
    bad = [(xs[i], got[i], want[i]) for i in got if abs(xs[i]) < limit and got[i] + 0.0 != want[i] + 0.0]
    assert bad == []
