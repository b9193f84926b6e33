"""Property checks of the measures."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.operators import reports as R
from tierline.operators import transforms as T

delay = st.one_of(st.none(), st.integers(-400, 900).map(float))
row = st.tuples(delay, delay, st.sampled_from([0, 1, None]), st.sampled_from(["AA", "BB", "ZZ", None]))

DDL = "DEPARTURE_DELAY double, ARRIVAL_DELAY double, CANCELLED int, AIRLINE string"


@settings(max_examples=15, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_rates_bounded_and_on_time_complements(spark, rows):
    df = spark.createDataFrame(rows, DDL).withColumnRenamed("AIRLINE", "AIRLINE_CODE")
    k = R.kpis(df).first()
    assert 0 <= k.delay_pct <= 100 and 0 <= k.cancel_pct <= 100
    assert abs(k.on_time_pct + k.delay_pct - 100) < 1e-9


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(delay, delay, delay, delay, delay), min_size=1, max_size=30))
def test_cause_shares_sum_to_100(spark, rows):
    raw = spark.createDataFrame(
        [tuple(abs(x) if x is not None else None for x in r) for r in rows],
        "AIRLINE_DELAY double, WEATHER_DELAY double, AIR_SYSTEM_DELAY double, LATE_AIRCRAFT_DELAY double, SECURITY_DELAY double",
    )
    shares = [r.share_pct for r in R.cause_totals(raw, shares=True).collect()]
    if all(s is not None for s in shares):
        assert abs(sum(shares) - 100) <= 0.05


@settings(max_examples=10, deadline=None)
@given(st.lists(row, min_size=0, max_size=30))
def test_enrich_keeps_rows_and_matched_plus_unmatched_is_total(spark, rows):
    clean = spark.createDataFrame(rows, DDL)
    dim = spark.createDataFrame([("AA", "Air A"), ("BB", "Air B")], "IATA_CODE string, AIRLINE string")
    fact = T.enrich(clean, dim)
    assert fact.count() == len(rows)
    unmatched = fact.filter("AIRLINE_NAME IS NULL").count()
    matched = sum(1 for r in rows if r[3] in ("AA", "BB"))
    assert matched + unmatched == len(rows)


part = st.one_of(st.none(), st.integers(-5, 2100))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(part, part, part, delay, delay, st.sampled_from([0, 1, None])), min_size=0, max_size=30))
def test_clean_keeps_rows_and_neutralises(spark, rows):
    ddl = "YEAR int, MONTH int, DAY int, DEPARTURE_DELAY double, ARRIVAL_DELAY double, CANCELLED int"
    raw = spark.createDataFrame(rows, ddl)
    out = T.clean(raw)
    got = out.collect()
    assert len(got) == len(rows)
    assert "YEAR" not in out.columns and out.columns[-1] == "FLIGHT_DATE"
    for r in got:
        if r.CANCELLED == 1:
            assert r.DEPARTURE_DELAY == 0.0 and r.ARRIVAL_DELAY == 0.0


def _r2(x):
    from decimal import ROUND_HALF_UP, Decimal

    return None if x is None else float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


fact_row = st.tuples(
    st.sampled_from(["AA", "BB", "CC", "HOT", "ZZ", None]),        # airline code (CC shares a name)
    st.one_of(st.none(), st.integers(-60, 200).map(float)),         # arrival delay
    st.sampled_from([None, 1, 2, 3]),                                # month of 2015
)


@settings(max_examples=12, deadline=None)
@given(st.lists(fact_row, min_size=0, max_size=40))
def test_reports_equal_brute_force(spark, rows):
    import datetime as dt

    from tierline.functions.filters import FactFilter

    names = {"AA": "Air A", "BB": "Air B", "CC": "Air A", "HOT": "Air Hot"}
    dim = spark.createDataFrame(list(names.items()), "IATA_CODE string, AIRLINE string")
    data = [(dt.date(2015, m, 1) if m else None, c, None, str(i), "X", "Y", 0.0, a, 0)
            for i, (c, a, m) in enumerate(rows)]
    fact = spark.createDataFrame(data, "FLIGHT_DATE date, AIRLINE_CODE string, AIRLINE_NAME string, "
                                       "FLIGHT_NUMBER string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, "
                                       "DEPARTURE_DELAY double, ARRIVAL_DELAY double, CANCELLED int")
    # leaderboard by name, inner join
    groups: dict = {}
    for c, a, _ in rows:
        if c in names:
            groups.setdefault(names[c], []).append(a)
    want = {}
    for name, vals in groups.items():
        present = [v for v in vals if v is not None]
        mean = sum(present) / len(present) if present else None
        late = sum(1 for v in vals if v is not None and v > 15)
        want[name] = (len(vals), _r2(mean), _r2(late * 100.0 / len(vals)))
    got = {r.airline: (r.num_flights, r.avg_arrival_delay, r.delay_pct)
           for r in R.airline_leaderboard(fact, dim).collect()}
    assert got == want
    # worst group: highest unrounded mean, ties by name, N/A when nothing joins
    means = {n: sum(v for v in vals if v is not None) / len([v for v in vals if v is not None])
             for n, vals in groups.items() if any(v is not None for v in vals)}
    worst = [r.airline for r in R.worst_airline(fact, dim).collect()]
    if means:
        top = max(means.values())
        assert worst == [min(n for n, m in means.items() if m == top)]
    elif groups:
        assert worst == [min(groups)]  # all means null: nulls last, then by name
    else:
        assert worst == ["N/A"]
    # trend with a date filter drops null months
    flt = FactFilter(date_from="2015-02-01")
    months: dict = {}
    for c, a, m in rows:
        if m is not None and m >= 2:
            months.setdefault(m, []).append(a)
    got_t = {r.period.month: (r.num_flights, r.avg_arrival_delay) for r in R.trend(fact, flt).collect()}
    want_t = {}
    for m, vals in months.items():
        present = [v for v in vals if v is not None]
        want_t[m] = (len(vals), _r2(sum(present) / len(present)) if present else None)
    assert got_t == want_t


ymd = st.tuples(
    st.one_of(st.none(), st.integers(0, 20000)),
    st.one_of(st.none(), st.integers(-200, 2000)),
    st.one_of(st.none(), st.integers(-200, 2000)),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(ymd, min_size=1, max_size=60))
def test_compose_date_equals_pattern_parse_random(spark, rows):
    from pyspark.sql import functions as F

    from tierline.functions.dates import compose_date, compose_date_by_pattern

    df = spark.createDataFrame(rows, "Y int, M int, D int")
    out = df.select(compose_date("Y", "M", "D").alias("f"), compose_date_by_pattern("Y", "M", "D").alias("s"))
    assert out.filter(~F.col("f").eqNullSafe(F.col("s"))).count() == 0
