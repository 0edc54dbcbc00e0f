"""Property tests against brute force: the bucketed time-bounded join finds exactly the pairs within
the bound (no misses at bucket edges, no duplicates), for any key skew."""

import datetime as dt
import itertools

from hypothesis import HealthCheck, given, settings, strategies as st

from martpulse.operators.pairs import pair_within

T0 = dt.datetime(2024, 1, 15)

rows = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 7200)), min_size=0, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=rows, right=rows, bound=st.sampled_from([1, 60, 600, 3600]))
def test_pair_within_equals_brute_force(spark, left, right, bound):
    lrows = [(i, k, T0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(left)]
    rrows = [(1000 + i, k, T0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(right)]
    l_df = spark.createDataFrame(lrows, "lid long, k long, lts timestamp")
    r_df = spark.createDataFrame(rrows, "rid long, k long, rts timestamp")
    got = sorted((r.lid, r.rid) for r in pair_within(l_df, r_df, "k", bound, "lts", "rts").collect())
    want = sorted((a[0], b[0]) for a, b in itertools.product(lrows, rrows)
                  if a[1] == b[1] and abs((b[2] - a[2]).total_seconds()) <= bound)
    assert got == want


events = st.lists(st.tuples(st.integers(1, 2), st.integers(1, 4), st.integers(0, 400),
                            st.sampled_from(["coupon", "coupon", "coupon", "addCart", "clickItem"])),
                  min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(evs=events, size=st.sampled_from([20, 45, 60, 100]), slide=st.sampled_from([10, 15, 30]))
def test_coupon_alert_panes_equal_brute_force(spark, evs, size, slide):
    from martpulse.operators.alerts import coupon_alerts

    rows = [(i, f"m{m}", f"u{u}", T0 + dt.timedelta(seconds=s), e, str(u % 2)) for i, (m, u, s, e) in enumerate(evs)]
    df = spark.createDataFrame(rows, "event_id long, mid string, uid string, ts timestamp, evid string, itemid string")
    got = {(r.mid, r.window_start, tuple(r.uids), tuple(r.item_ids), tuple(r.events))
           for r in coupon_alerts(df, size, slide, min_uids=2).collect()}
    want = set()
    epoch = dt.datetime(1970, 1, 1)
    secs = [int((r[3] - epoch).total_seconds()) for r in rows]
    starts = {s - s % slide - k * slide for s in secs for k in range(size // slide + 2)}
    for start in starts:
        for mid in {r[1] for r in rows}:
            grp = sorted([r for r, t in zip(rows, secs) if r[1] == mid and start <= t < start + size],
                         key=lambda r: (r[3], r[0]))
            uids = sorted({r[2] for r in grp if r[4] == "coupon"})
            if len(uids) >= 2 and not any(r[4] == "clickItem" for r in grp):
                items = sorted({r[5] for r in grp if r[4] == "coupon"})
                want.add((mid, epoch + dt.timedelta(seconds=start), tuple(uids), tuple(items),
                          tuple(r[4] for r in grp)))
    assert got == want
