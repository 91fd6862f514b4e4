"""Property tests (hypothesis): keep-first and pivot against pandas, the day
type against Python's calendar."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from voltlake.operators.dedupe import keep_first, pivot_first

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 4),
                          st.sampled_from(["Solar", "Wind", "Gas"]),
                          st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False))),
                min_size=1, max_size=40)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=ROWS)
def test_keep_first_is_pandas_drop_duplicates(spark, rows):
    data = [(k, t, typ, q, i) for i, (k, t, typ, q) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, t int, typ string, q double, ingest_order long")
    got = sorted((r.k, r.t, r.typ, r.q) for r in keep_first(df, ["k", "t"]).collect())
    pdf = pd.DataFrame(data, columns=["k", "t", "typ", "q", "ingest_order"]).drop_duplicates(subset=["k", "t"])
    exp = sorted((r.k, r.t, r.typ, None if pd.isna(r.q) else r.q) for r in pdf.itertuples())
    assert got == exp


@SETTINGS
@given(rows=ROWS)
def test_pivot_first_is_dedupe_then_pivot(spark, rows):
    data = [(k, t, typ, q, i) for i, (k, t, typ, q) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, t int, typ string, q double, ingest_order long")
    types = ["Solar", "Wind", "Gas"]
    got = {(r.k, r.t): tuple(r[c] for c in types)
           for r in pivot_first(df, ["k", "t"], "typ", "q", types).collect()}
    pdf = pd.DataFrame(data, columns=["k", "t", "typ", "q", "ingest_order"])
    pdf = pdf.drop_duplicates(subset=["k", "t", "typ"])
    exp = {}
    for r in pdf.itertuples():
        cur = list(exp.get((r.k, r.t), (None, None, None)))
        cur[types.index(r.typ)] = None if pd.isna(r.q) else r.q
        exp[(r.k, r.t)] = tuple(cur)
    assert got == exp


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=st.lists(st.dates(dt.date(2020, 1, 1), dt.date(2030, 12, 31)), min_size=1, max_size=20),
       hol=st.lists(st.dates(dt.date(2020, 1, 1), dt.date(2030, 12, 31)), max_size=5))
def test_day_type_matches_python(spark, days, hol):
    from voltlake.functions.timefn import day_type
    df = spark.createDataFrame([(dt.datetime.combine(d, dt.time(13, 30)),) for d in days], "ts timestamp_ntz")
    got = [r.k for r in df.select(day_type("ts", [h.isoformat() for h in hol]).alias("k")).collect()]
    exp = ["Holiday" if d in hol else "Weekend" if d.weekday() >= 5 else "Working Day" for d in days]
    assert got == exp
