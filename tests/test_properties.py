"""Property tests (hypothesis, few examples: each example runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyfold.operators import activity, scd
from tallyfold.plans.sequence import sequence_positions

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)

labels = st.sampled_from(["a", "b", None])
histories = st.dictionaries(
    st.sampled_from(["k1", "k2", "k3"]),
    st.lists(st.tuples(st.integers(1, 12), labels), min_size=1, max_size=10, unique_by=lambda t: t[0]),
    min_size=1,
)


def _brute_scd(hist):
    out = []
    for k, seq in hist.items():
        seq = sorted(seq)
        start = prev = None
        cur = object()
        for p, v in seq:
            if start is None or v != cur:
                if start is not None:
                    out.append((k, cur, start, prev))
                start, cur = p, v
            prev = p
        out.append((k, cur, start, prev))
    return sorted(out, key=lambda t: tuple(str(x) for x in t))


@SETTINGS
@given(histories)
def test_scd_backfill_matches_brute_force(spark, hist):
    data = [(k, p, v) for k, seq in hist.items() for p, v in seq]
    df = spark.createDataFrame(data, "k string, p int, c string")
    got = scd.scd2_backfill(df, ["k"], "p", ["c"], as_of_col=None).collect()
    assert sorted((tuple(r) for r in got), key=lambda t: tuple(str(x) for x in t)) == _brute_scd(hist)


events = st.lists(
    st.tuples(st.sampled_from(["h1", "h2"]), st.integers(1, 6), st.integers(0, 40)),
    min_size=1,
    max_size=40,
)


@SETTINGS
@given(events)
def test_monthly_closed_form_matches_brute_force(spark, evs):
    # day offsets 0..40 from Jan 20 cross a month boundary
    base = dt.date(2024, 1, 20)
    rows_ = [(i, u, h, dt.datetime.combine(base + dt.timedelta(days=o), dt.time(1, i % 60))) for i, (h, u, o) in enumerate(evs)]
    df = spark.createDataFrame(rows_, "event_id bigint, user_id bigint, host string, event_time timestamp_ntz")
    as_of = base + dt.timedelta(days=max(o for _, _, o in evs))
    got = {
        (r.host, r.month_start): (r.hit_array, r.unique_visitors)
        for r in activity.reduce_monthly_backfill(df, as_of, "host").collect()
    }
    exp = {}
    for _, u, h, ts in rows_:
        d = ts.date()
        m = d.replace(day=1)
        if (h, m) not in exp:
            nxt = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
            n = as_of.day if m == as_of.replace(day=1) else (nxt - m).days
            exp[(h, m)] = ([0] * n, [set() for _ in range(n)])
        exp[(h, m)][0][d.day - 1] += 1
        exp[(h, m)][1][d.day - 1].add(u)
    exp = {k: (hits, [len(s) for s in vis]) for k, (hits, vis) in exp.items()}
    assert got == exp


keyed = st.lists(st.tuples(st.sampled_from([0, 0, 0, 1, 2, None]), st.integers(0, 10_000)), min_size=1, max_size=120, unique_by=lambda t: t)


@SETTINGS
@given(keyed, st.integers(1, 9))
def test_sequence_positions_match_python(spark, data, n_parts):
    df = spark.createDataFrame([(k, t, t % 3) for k, t in data], "k int, t int, v int")
    got = {(r.k, r.t): (r._pos, r.v_cum) for r in sequence_positions(df, ["k"], ["t"], sums=["v"], n_partitions=n_parts).collect()}
    exp = {}
    for k in {k for k, _ in data}:
        ts = sorted(t for kk, t in data if kk == k)
        cum = 0
        for i, t in enumerate(ts):
            cum += t % 3
            exp[(k, t)] = (i, cum)
    assert got == exp


from tallyfold.operators import merge  # noqa: E402
from tallyfold.operators.dedupe import dedupe_counted  # noqa: E402

pairs = st.lists(st.tuples(st.sampled_from([1, 2, 3, None]), st.sampled_from(["x", "y", "z"])), min_size=1, max_size=30)


@SETTINGS
@given(pairs)
def test_dedupe_counted_matches_python(spark, data):
    df = spark.createDataFrame(data, "k bigint, v string")
    got = {r.k: (r.v, r.row_num) for r in dedupe_counted(df, ["k"]).collect()}
    exp = {}
    for k, v in data:
        best, n = exp.get(k, (v, 0))
        exp[k] = (min(best, v), n + 1)
    assert got == exp


updates = st.dictionaries(st.integers(0, 8), st.floats(-5, 5, allow_nan=False), max_size=6)


@SETTINGS
@given(updates, updates)
def test_upsert_matches_dict_semantics(spark, target, upd):
    t = spark.createDataFrame([(k, f"n{k}", v) for k, v in target.items()] or [], "k bigint, name string, v double")
    u = spark.createDataFrame([(k, v) for k, v in upd.items()] or [], "k bigint, v double")
    got = {r.k: (r.name, r.v) for r in merge.upsert(t, u, ["k"], ["v"]).collect()}
    exp = {k: (f"n{k}", v) for k, v in target.items()}
    for k, v in upd.items():
        exp[k] = (exp[k][0] if k in exp else None, v)
    assert got == exp


day_events = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 9)), min_size=1, max_size=25)


@SETTINGS
@given(day_events)
def test_host_fold_matches_python(spark, evs):
    import datetime as dt

    from tallyfold.operators import cumulate
    from tallyfold.streaming import fold_periods

    base = dt.date(2024, 3, 1)
    rows_ = [(i, 1, h, dt.datetime.combine(base + dt.timedelta(days=o), dt.time(12))) for i, (h, o) in enumerate(evs)]
    df = spark.createDataFrame(rows_, "event_id bigint, user_id bigint, host string, event_time timestamp_ntz")
    days = [base + dt.timedelta(days=i) for i in range(10)]
    last = fold_periods(lambda prev, d: cumulate.cumulate_hosts(prev, df, d), days)
    got = {r.host_name: r.host_activity_datelist for r in last.collect()}
    exp = {}
    for h, o in evs:
        exp.setdefault(h, set()).add(base + dt.timedelta(days=o))
    assert got == {h: sorted(ds) for h, ds in exp.items()}
