"""Property tests: ranking and period change against a pandas brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from countlens.operators.ranking import top_n_by_period
from countlens.plans.reports import growth_report

rows = st.lists(
    st.tuples(
        st.sampled_from(["2020-01-01", "2020-01-02", "2020-06-30", None]),
        st.one_of(st.none(), st.integers(1, 6)),
        st.one_of(st.none(), st.integers(-3, 50)),
    ),
    min_size=0,
    max_size=40,
)


def _key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, n=st.integers(1, 4))
def test_top_n_matches_bruteforce(spark, data, n):
    df = spark.createDataFrame(data, "p string, k int, v int")
    got = sorted(
        ((r.p, r.k, r.t, r.rank) for r in top_n_by_period(df, "p", "k", "v", n, "t").collect()),
        key=_key,
    )
    groups = {}
    for p, k, v in data:
        cur = groups.setdefault((p, k), [])
        if v is not None:
            cur.append(v)
    totals = [(p, k, sum(vs) if vs else None) for (p, k), vs in groups.items()]
    want = []
    for p in {t[0] for t in totals}:
        part = [t for t in totals if t[0] == p]
        # value descending with NULL last, then key ascending with NULL first
        part.sort(key=lambda t: (t[2] is None, -(t[2] or 0), t[1] is not None, t[1] or 0))
        want += [(pp, k, t, i + 1) for i, (pp, k, t) in enumerate(part[:n])]
    assert got == sorted(want, key=_key)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_change_matches_bruteforce(spark, data):
    df = spark.createDataFrame(data, "p string, k int, v int")
    base, cur = ("2020-01-01", "2020-01-02"), ("2020-01-02", "2020-07-01")
    labels = spark.createDataFrame([(k, f"L{k}") for k in range(0, 50, 2)], "k int, label string")
    got = {
        r.sensor_id: (r.b, r.c, r.d, r.pct, r.location_name)
        for r in growth_report(
            df, labels, base, cur, ts_col="p", id_col="k", value_col="v", dim_key="k", label_col="label",
            names=("b", "c", "d", "pct"),
        ).collect()
    }

    def total(lo, hi):
        out = {}
        for p, k, v in data:
            if p is not None and k is not None and lo <= p < hi:
                out.setdefault(k, []).append(v)
        return {k: (sum(x for x in vs if x is not None) if any(x is not None for x in vs) else None)
                for k, vs in out.items()}

    a, b = total(*base), total(*cur)
    want = {}
    for k in a.keys() & b.keys():
        d = None if a[k] is None or b[k] is None else b[k] - a[k]
        pct = None if d is None or not a[k] else d / a[k] * 100.0
        want[k] = (a[k], b[k], d, pct)
    assert got.keys() == want.keys()
    for k in got:
        assert got[k][:3] == want[k][:3]
        assert got[k][4] == (f"L{k}" if k % 2 == 0 and 0 <= k < 50 else None)
        if want[k][3] is None:
            assert got[k][3] is None
        else:
            assert abs(got[k][3] - want[k][3]) < 1e-9


hourly = st.lists(
    st.tuples(
        st.one_of(
            st.none(),
            st.builds(
                "{}T{:02d}:00:00".format,
                st.sampled_from(["2019-12-31", "2020-01-01", "2020-01-02", "2020-03-31",
                                 "2020-04-01", "2020-06-30", "2020-07-01"]),
                st.integers(0, 23),
            ),
        ),
        st.one_of(st.none(), st.integers(1, 5)),
        st.one_of(st.none(), st.integers(0, 40)),
    ),
    min_size=0,
    max_size=40,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=hourly)
def test_reports_from_day_totals_equal_reports_from_hours(spark, data):
    """Change and ranking reports from day totals (sum + raw row count per
    day and key) equal the reports from the hourly rows, whatever the NULLs."""
    from countlens.operators.periods import day_totals
    from countlens.plans.reports import decline_report, top_n_by_day, top_n_from_day_totals

    df = spark.createDataFrame(data, "date_time string, sensor_id int, hourly_count int")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "location_id int, sensor_description string")
    days = day_totals(df, "date_time", "sensor_id", "hourly_count")
    base, cur = ("2020-01-01", "2020-04-01"), ("2020-04-01", "2020-07-01")

    def rows(d):
        return sorted(map(tuple, d.collect()), key=_key)

    assert rows(decline_report(days, dim, base, cur, ts_col="day", value_col="total",
                               rows_col="n_rows")) == rows(decline_report(df, dim, base, cur))
    assert rows(top_n_from_day_totals(days, dim, n=2)) == rows(top_n_by_day(df, dim, n=2))
