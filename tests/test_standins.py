"""The stand-in tables of the queries: pollen responses and the wide table, from rows with gaps and repeats."""

import datetime as dt
import json
from collections import defaultdict

import pytest

from checks import standins
from stationday.operators import merge

AT = dt.datetime(2024, 1, 5, 7, 30)
EVENTS = [
    # user_id, event_type, value, k
    (1, "click", 4.5, 0),
    (1, "click", 9.0, 0),  # 9 is 2 of 7
    (1, "view", None, 12),
    (1, "view", None, 12),
    (1, "error", -3.5, 16),  # -4 of 7 stays below 0
    (2, "purchase", 7.0, 14),
    (2, "other", 3.0, 1),  # a type that nothing is known of
    (2, None, None, 2),
    (3, "signup", 6.0, 33),
    (None, "click", 1.0, 5),
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("standins"))
    rows = [
        (i, AT + dt.timedelta(days=i % 2), user, kind, value, json.dumps({"k": k}))
        for i, (user, kind, value, k) in enumerate(EVENTS * 2)
    ]
    ddl = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, ddl).write.parquet(f"{root}/events.parquet")
    # station 1 comes twice, station 3 is unknown
    customers = [(1, "Nire"), (1, "Buna"), (2, "Kaya")]
    spark.createDataFrame(customers, "c_custkey long, c_name string").write.parquet(f"{root}/customer.parquet")
    suppliers = [(1, "W1"), (2, "W2")]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string").write.parquet(f"{root}/supplier.parquet")
    return root


def expected_lists():
    """Per station and day the largest value of each code, as sorted texts."""
    values = defaultdict(lambda: defaultdict(list))
    for i, (user, kind, value, k) in enumerate(EVENTS * 2):
        station = None if user is None else str(user)
        day = (AT + dt.timedelta(days=i % 2)).date()
        index = None if value is None else int(abs(value // 1) % 7 * (1 if value >= 0 else -1))
        plant = standins.CODES[k % len(standins.CODES)]
        values[station, day]["type", standins.TYPES.get(kind)].append(index)
        values[station, day]["plant", plant].append(index)
    return {
        key: sorted((kind, str(code), max((v for v in found if v is not None), default=None)) for (kind, code), found in codes.items())
        for key, codes in values.items()
    }


def listed(response):
    (day,) = json.loads(response)["dailyInfo"]
    entries = [("type", e) for e in day["pollenTypeInfo"]] + [("plant", e) for e in day["plantInfo"]]
    for kind, e in entries:
        if kind == "plant":
            assert e["plantDescription"] == {"type": standins.PLANT_TYPES.get(e.get("code"), "TREE")}
    return sorted((kind, str(e.get("code")), e["indexInfo"].get("value")) for kind, e in entries)


def test_responses_list_each_code_once_with_its_largest_value(spark, tables):
    expected = expected_lists()
    found = defaultdict(list)
    for row in standins.responses(spark, tables).collect():
        date = json.loads(row.response)["dailyInfo"][0]["date"]
        assert dt.date(date["year"], date["month"], date["day"]) == row.snapshot_date
        found[row.station_id, row.snapshot_date].append(listed(row.response))
    assert {key: lists[0] for key, lists in found.items()} == expected
    # one row for each row of the master, one without coordinates where it has none
    assert {key[0]: len(lists) for key, lists in found.items()} == {"1": 2, "2": 1, "3": 1, None: 1}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_responses_shuffle_numbers_once_for_all_codes(spark, tables):
    """Neither a row for a code of an event nor the lists themselves are shuffled."""
    made = plan(standins.responses(spark, tables))
    assert "Generate" not in made and "collect_list" not in made
    assert "ObjectHashAggregate" not in made


def test_few_texts_are_coded_in_one_scan(spark, tables):
    """Texts that fit a broadcast are not worth a second scan for the rows without one."""
    long = standins.long_events(spark, tables)
    coded, codes = merge.with_ordered_codes(long)
    assert plan(coded).count("events.parquet") == 1
    texts = {r.code: r.text for r in codes.collect()}
    assert list(texts.values()) == sorted(texts.values()) and sorted(texts) == list(texts)
    keys = ["station_id", "date", "source", "observed_at", "quality"]
    given = sorted(map(str, ((*(r[k] for k in keys), r.direction) for r in long.collect())))
    assert sorted(map(str, ((*(r[k] for k in keys), texts.get(r.code)) for r in coded.collect()))) == given


def test_many_texts_are_coded_by_a_shuffle(spark, tables, monkeypatch):
    """The same rows where the texts are too many to broadcast."""
    long = standins.long_events(spark, tables)
    few = merge.wide_rows(long).collect()
    monkeypatch.setattr(merge, "broadcast_if_small", lambda small: small)
    many = merge.wide_rows(long)
    assert len(few) == 4 and sorted(map(str, many.collect())) == sorted(map(str, few))


def test_json_text_is_made_once_and_not_within_its_parser(spark, tables):
    """``to_json`` stays a projection of its own, below that of ``from_json``."""
    made = [line for line in plan(standins.pollen(spark, tables)).splitlines() if "StructsToJson" in line]
    assert len(made) == 1 and "from_json" not in made[0]
