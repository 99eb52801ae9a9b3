import random
from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strataq.operators import intervals as iv

S = "k string, f date, t date, start_day int, finding string"
D0 = date(2024, 1, 1)


def closed(spark, rows):
    return iv.closed_intervals(spark.createDataFrame([(*r, 7, "clash") for r in rows], S), ["k"], "f", "t")


def brute(rows, depth):
    """Runs of days covered at least ``depth`` times, per key, day by day."""
    out = []
    for k in {r[0] for r in rows}:
        days = {}
        for key, f, t in rows:
            if key == k and f and (t or date(2024, 3, 1)) >= f:
                d = f
                while d <= (t or date(2024, 3, 1)):
                    days[d] = days.get(d, 0) + 1
                    d += timedelta(1)
        hit = sorted(d for d, n in days.items() if n >= depth)
        for d in hit:
            if out and out[-1][0] == k and out[-1][2] + timedelta(1) == d:
                out[-1][2] = d
            else:
                out.append([k, d, d])
    return sorted((tuple(x) for x in out), key=repr)


def test_cases(spark, rows):
    d = lambda n: D0 + timedelta(n)
    data = [("a", d(0), d(4)), ("a", d(5), d(9)), ("a", d(20), None), ("a", None, d(3)), ("a", d(9), d(2)), ("b", d(1), d(1)), ("b", d(1), d(1)), (None, d(3), d(8)), (None, d(4), d(5))]
    x = closed(spark, data)
    assert rows(iv.merge_intervals(x, ["k"])) == sorted([("a", d(0), d(9)), ("a", d(20), date(9999, 12, 31)), ("b", d(1), d(1)), (None, d(3), d(8))], key=repr)
    assert rows(iv.gaps(iv.merge_intervals(x, ["k"]), ["k"])) == [("a", d(10), d(19))]
    assert rows(iv.overlaps(x, ["k"])) == sorted([("b", d(1), d(1)), (None, d(4), d(5))], key=repr)
    assert rows(iv.interval_findings(x, ["k"]), "k", "finding") == sorted([("a", "gap"), ("b", "overlap"), (None, "overlap")], key=repr)


def test_empty(spark):
    x = closed(spark, [])
    assert iv.interval_findings(x, ["k"]).count() == 0
    assert iv.merge_intervals(x, ["k"]).count() == 0


def test_open_ends_overlap(spark, rows):
    x = closed(spark, [("a", D0, None), ("a", D0 + timedelta(3), None)])
    assert rows(iv.overlaps(x, ["k"])) == [("a", D0 + timedelta(3), date(9999, 12, 31))]
    assert iv.gaps(iv.merge_intervals(x, ["k"]), ["k"]).count() == 0


def test_hot_key_against_days(spark, rows):
    r = random.Random(3)
    data = [("hot" if i % 3 == 0 else f"k{i % 5}", D0 + timedelta(r.randrange(50)), None) for i in range(300)]
    data = [(k, f, f + timedelta(r.randrange(-1, 4))) for k, f, _ in data]
    x = closed(spark, data)
    assert rows(iv.merge_intervals(x, ["k"])) == brute(data, 1)
    assert rows(iv.overlaps(x, ["k"])) == brute(data, 2)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 25), st.integers(-1, 6)), max_size=14))
def test_random(spark, rows, data):
    data = [(k, D0 + timedelta(s), D0 + timedelta(s + n)) for k, s, n in data]
    x = closed(spark, data)
    assert rows(iv.merge_intervals(x, ["k"])) == brute(data, 1)
    assert rows(iv.overlaps(x, ["k"])) == brute(data, 2)
