"""Property checks: parse inverts format for durations; the
value map is idempotent on its own outputs."""

from hypothesis import given, settings
from hypothesis import strategies as st

from paddock.functions import text, timefmt

durations = st.tuples(
    st.integers(0, 9), st.integers(0, 59), st.integers(0, 59), st.integers(0, 999), st.sampled_from(["hms", "ms", "s"])
)


def _fmt(h, m, s, f, layout):
    if layout == "hms":
        return f"{h}:{m:02d}:{s:02d}.{f:03d}", ((h * 60 + m) * 60 + s) * 1000 + f
    if layout == "ms":
        return f"{m}:{s:02d}.{f:03d}", (m * 60 + s) * 1000 + f
    return f"{s}.{f:03d}", s * 1000 + f


@settings(max_examples=1, deadline=None)
@given(st.lists(durations, min_size=50, max_size=200))
def test_time_to_ms_inverts_formatting(spark, cases):
    pairs = [_fmt(*c) for c in cases]
    df = spark.createDataFrame([(t,) for t, _ in pairs], "x string")
    got = [r[0] for r in df.select(timefmt.time_to_ms("x")).collect()]
    assert got == [ms for _, ms in pairs]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.sampled_from(list(text.RACE_DATA_VALUE_MAP) + ["Ferrari", "12", "", "Retired"]), min_size=20))
def test_value_map_is_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    once = df.select(text.map_values("x", text.RACE_DATA_VALUE_MAP).alias("x"))
    twice = once.select(text.map_values("x", text.RACE_DATA_VALUE_MAP).alias("x"))
    assert [r[0] for r in once.collect()] == [r[0] for r in twice.collect()]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.dates(min_value=__import__("datetime").date(1930, 1, 1),
                         max_value=__import__("datetime").date(2029, 12, 31)), min_size=30, max_size=120))
def test_multi_format_date_round_trips(spark, dates):
    # every layout of the rule, two-digit years included, parses back to the same day under the pivot
    layouts = [
        lambda d: d.isoformat(),
        lambda d: d.strftime("%m/%d/%y"),
        lambda d: f"{d.month}/{d.day}/{d.strftime('%y')}",
        lambda d: f"{d.month}/{d.day:02d}/{d.strftime('%y')}",
        lambda d: f"{d.month:02d}/{d.day}/{d.strftime('%y')}",
    ]
    texts = [(layouts[i % 5](d), d) for i, d in enumerate(dates)]
    df = spark.createDataFrame([(t,) for t, _ in texts], "x string")
    got = [r[0] for r in df.select(timefmt.parse_multi_format_date("x")).collect()]
    assert got == [d for _, d in texts]
