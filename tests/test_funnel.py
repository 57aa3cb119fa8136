import datetime as dt

from tillroll.operators.funnel import search_funnel


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_funnel_hand_fixture(spark):
    rows = [
        # session a spans two months; it counts once in each
        (ts("2024-01-31 23:50:00"), "a", "input-focused"),
        (ts("2024-02-01 00:10:00"), "a", "input-changed"),
        # session b uses both submit ways -> counted twice in sessions_submitted
        (ts("2024-01-10 10:00:00"), "b", "enter"),
        (ts("2024-01-10 10:01:00"), "b", "click-search-icon"),
        (ts("2024-01-10 10:02:00"), "b", "click-view-all"),
        # session c has a null label only
        (ts("2024-01-11 09:00:00"), "c", None),
    ]
    df = spark.createDataFrame(rows, "derived_tstamp timestamp, domain_sessionid string, se_label string")
    out = {r["event_date"].isoformat(): r.asDict() for r in search_funnel(df).collect()}
    jan, feb = out["2024-01-01"], out["2024-02-01"]
    assert jan["total_sessions"] == 3 and feb["total_sessions"] == 1
    assert jan["sessions_focused"] == 1 and feb["sessions_typed"] == 1
    assert jan["sessions_submitted"] == 2
    assert jan["sessions_clicked_view_all"] == 1


def test_funnel_daily_period(spark):
    rows = [(ts("2024-01-01 10:00:00"), "a", "enter"), (ts("2024-01-02 10:00:00"), "a", "enter")]
    df = spark.createDataFrame(rows, "derived_tstamp timestamp, domain_sessionid string, se_label string")
    out = search_funnel(df, period="day").collect()
    assert [r["total_sessions"] for r in out] == [1, 1]


def test_funnel_with_other_steps(spark):
    import pytest

    rows = [(ts("2024-01-01 10:00:00"), "a", "view"), (ts("2024-01-01 11:00:00"), "a", "buy"), (ts("2024-01-02 10:00:00"), "b", "view")]
    df = spark.createDataFrame(rows, "derived_tstamp timestamp, domain_sessionid string, se_label string")
    r = search_funnel(df, steps={"opened": "view", "bought": "buy"}).first()
    assert (r["total_sessions"], r["sessions_opened"], r["sessions_bought"]) == (2, 2, 1)
    r = search_funnel(df, steps={"opened": "view", "bought": "buy"}, columns={"any": ("opened", "bought")}).first()
    assert r["sessions_any"] == 3
    with pytest.raises(ValueError):
        search_funnel(df, steps={"opened": "view"}, columns={"x": ("bought",)})
