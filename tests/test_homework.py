import datetime as dt

import pytest
from conftest import rows

from roost import HomeWorkParams, classify_home_work, extract_home_work
from roost.operators.homework import home_hours, work_hours
from roost.schemas import HW, LOCAL

M = 1 / 111_194.9
MONDAY = dt.datetime(2024, 1, 1)
SMALL = HomeWorkParams(home_min_days=2, work_min_days=2)


def stay(n, day, hour, label, metres, uid="a", size=9):
    at = MONDAY + dt.timedelta(days=day, hours=hour)
    weekday = at.isoweekday() % 7 + 1
    lat = 10 + metres * M
    return (
        uid, n, n, n + 600, 600, lat, 20.0, label, size if label >= 0 else 1, lat, 20.0,
        None, "UTC", at, at, at.date(), at.year, at.month, at.day, at.hour, weekday, weekday in (1, 7), at.date(),
    )


def local(spark, *stays):
    return spark.createDataFrame([stay(n, *s) if len(s) < 7 else s for n, s in enumerate(stays)], LOCAL)


def types(df):
    return "".join(r.location_type for r in sorted(df.collect(), key=lambda r: r.stop_event))


HOME = [(d, 22, 0, 0) for d in range(3)]
OFFICE = [(d, 11, 1, 500) for d in range(3)]


def test_home_work_other(spark):
    df = classify_home_work(local(spark, *HOME, *OFFICE, (4, 13, -1, 900), (4, 13, 2, 700)), SMALL)
    assert types(df) == "HHHWWWOO"
    assert [v for _, v in rows(df, "stop_event", "location_label")] == [1] * 6 + [-1] * 2
    assert {f.name: f.dataType for f in df.schema} == {f.name: f.dataType for f in HW}


def test_hours(spark):
    days = [(0, h, 0, 0) for h in (7, 8, 9, 18, 19)] + [(5, 12, 0, 0)]
    df = local(spark, *days)
    p = HomeWorkParams()
    assert [h for _, h in rows(df.where(home_hours(p)), "stop_event", "hour")] == [7, 19, 12]
    assert [h for _, h in rows(df.where(work_hours(p)), "stop_event", "hour")] == [9, 18]


def test_home_days_count_at_any_hour(spark):
    # One night and two noons: three days seen, one home-hour visit.
    seen = [(0, 22, 0, 0), (1, 8, 0, 0), (2, 8, 0, 0)]
    assert types(classify_home_work(local(spark, *seen), HomeWorkParams(home_min_days=3))) == "HHH"
    assert types(classify_home_work(local(spark, *seen), HomeWorkParams(home_min_days=4))) == "OOO"


def test_cluster_never_seen_in_home_hours_is_no_home(spark):
    assert types(classify_home_work(local(spark, *OFFICE), SMALL)) == "OOO"


def test_no_work_without_home_nor_at_home(spark):
    only_office = local(spark, *OFFICE)
    assert "W" not in types(classify_home_work(only_office, SMALL))
    at_home = local(spark, *HOME, *[(d, 11, 0, 0) for d in range(3)])
    assert types(classify_home_work(at_home, SMALL)) == "HHHHHH"


@pytest.mark.parametrize("metres, kind", [(49, "O"), (51, "W")])
def test_work_must_be_far_enough(spark, metres, kind):
    office = [(d, 11, 1, metres) for d in range(3)]
    assert types(classify_home_work(local(spark, *HOME, *office), SMALL)) == "HHH" + kind * 3


def test_ineligible_first_choice_leaves_the_next(spark):
    # Cluster 1 has most home visits, but on one day only.
    once = [(0, 20 + h, 1, 500) for h in range(4)]
    assert types(classify_home_work(local(spark, *HOME, *once), SMALL)) == "HHHOOOO"


def test_ties_go_by_days_then_label(spark):
    p = HomeWorkParams(home_min_days=1)
    by_days = [(0, 22, 0, 0), (0, 23, 0, 0), (1, 22, 1, 500), (2, 22, 1, 500)]
    assert types(classify_home_work(local(spark, *by_days), p)) == "OOHH"
    by_label = [(0, 22, 1, 0), (1, 22, 1, 0), (0, 23, 0, 500), (1, 23, 0, 500)]
    assert types(classify_home_work(local(spark, *by_label), p)) == "OOHH"


def test_large_clusters_and_noise_are_split_without_loss(spark):
    noise = [(4, 13, -1, 900 + k) for k in range(5)]
    df = local(spark, *HOME, *OFFICE, *noise)
    for per_task in (1, 2, 4):
        assert types(classify_home_work(df, SMALL, stops_per_task=per_task)) == "HHHWWWOOOOO"


def test_unknown_device_is_other(spark):
    data = [(None, *stay(n, *s)[1:]) for n, s in enumerate(HOME)]
    assert types(classify_home_work(spark.createDataFrame(data, LOCAL), SMALL)) == "OOO"


def test_pairs_by_year(spark):
    later = [(d + 366, 22, 0, 0) for d in range(2)]
    lonely = [stay(90 + d, d, 22, 0, 0, uid="b") for d in range(3)]
    hw = classify_home_work(local(spark, *HOME, *OFFICE, *later, *lonely), SMALL)
    assert rows(extract_home_work(hw), "uid", "year") == [("a", 2024)]
    every = extract_home_work(hw, keep_unmatched=True, limit=None)
    assert rows(every, "uid", "year") == [("a", 2024), ("a", 2025), ("b", 2024)]
    assert extract_home_work(hw, keep_unmatched=True, limit=2).count() == 2
    assert [tuple(r) for r in every.select("uid", "year").collect()] == rows(every, "uid", "year")
