from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.functions.instants import utc_micros
from ledgerloom.operators import instants as I


def micros(*args, zone="UTC"):
    return (datetime(*args, tzinfo=ZoneInfo(zone)).astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


def test_forms():
    cases = [
        ("2024-03-01T10:20:30Z", None, micros(2024, 3, 1, 10, 20, 30)),
        (" 2024-03-01t10:20:30z ", "Asia/Kolkata", micros(2024, 3, 1, 10, 20, 30)),
        ("2024-03-01 10:20:30", "Asia/Kolkata", micros(2024, 3, 1, 4, 50, 30)),
        ("2024-03-01T10:20:30.123456789Z", None, micros(2024, 3, 1, 10, 20, 30, 123456)),
        ("2024-03-01T10:20+05:30", None, micros(2024, 3, 1, 4, 50)),
        ("2024-03-01T10:20:30-0330", None, micros(2024, 3, 1, 13, 50, 30)),
        ("20240301T102030Z", None, micros(2024, 3, 1, 10, 20, 30)),
        ("2024-03-01", "Europe/Paris", micros(2024, 2, 29, 23)),
        ("01/02/2024 18:16", "Europe/London", micros(2024, 2, 1, 18, 16)),
        ("31-Mar-2024 08:32:08", "Europe/London", micros(2024, 3, 31, 7, 32, 8)),
        ("Fri, 01 Nov 2024 07:52:35 +0100", None, micros(2024, 11, 1, 6, 52, 35)),
        ("10 October 2022 3:26am", "Europe/London", micros(2022, 10, 10, 2, 26)),
        ("13 March 2022 12:10am", None, micros(2022, 3, 13, 0, 10)),
        ("11 October 2025 12:56pm", None, micros(2025, 10, 11, 12, 56)),
        ("2022-08-06 01:14:56 CEST", "Asia/Kolkata", micros(2022, 8, 5, 23, 14, 56)),
        ("2022-08-06 01:14:56 BST", None, micros(2022, 8, 6, 0, 14, 56)),
        ("2022-03-13T10:52:55[Europe/Paris]", None, micros(2022, 3, 13, 9, 52, 55)),
        ("1647159009", None, 1647159009_000000), ("1647148071069", "Asia/Kolkata", 1647148071069_000), ("1647161153865151", None, 1647161153865151), ("1647161153865151999", None, 1647161153865151),
        ("2024-10-27T01:30:00", "Europe/London", micros(2024, 10, 27, 0, 30)),  # happens twice: the first
        ("2024-03-31T01:30:00", "Europe/London", micros(2024, 3, 31, 1, 30)),  # skipped: the offset before
        ("2024-03-01 10:00:00", "No/Where", micros(2024, 3, 1, 10)),
    ]
    for text, zone, want in cases:
        assert utc_micros(text, zone) == want, text


def test_no_instant():
    for text in [None, "", "  ", "-", "n/a", "TBC", "pending", "None", "not yet published", "0000-00-00T00:00:00Z", "2021-13-04 08:00:00", "2019-00-12", "31/02/2024 10:00", "2024-03-01T25:00:00Z", "2024-03-01T10:61:00Z", "2024-03-01 10:00:00 QQQ", "13 March 2022 13:10pm", "2024-03-01x", "9" * 30]:
        assert utc_micros(text) is None, text


@settings(max_examples=200, deadline=None)
@given(st.datetimes(datetime(1950, 1, 1), datetime(2090, 1, 1)), st.sampled_from(["UTC", "Europe/London", "America/New_York", "Asia/Kolkata"]))
def test_written_and_read(when, zone):
    wall = when.replace(tzinfo=ZoneInfo(zone))
    want = (wall.astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)
    assert utc_micros(when.isoformat(), zone) == want
    assert utc_micros(when.isoformat() + f"[{zone}]", "Europe/Paris") == want
    seconds = when.replace(microsecond=0)
    want0 = want - when.microsecond
    assert utc_micros(seconds.strftime("%d %B %Y %H:%M:%S"), zone) == want0
    assert utc_micros(seconds.strftime("%Y%m%dT%H%M%S"), zone) == want0


def rows(spark, data):
    return spark.createDataFrame([("s", k, "f", t, z) for k, t, z in data], "source_table string, row_key string, field_name string, text string, zone string")


def test_dictionary_grows_and_joins_back(spark):
    d = I.InstantDictionary(spark)
    first = I.normalise(rows(spark, [("1", "2024-01-01T00:00:00Z", None), ("1", "2024-01-01T00:00:00Z", None), ("2", "pending", "UTC"), ("3", None, None), ("4", "", None)]), d).collect()
    assert sorted((r["row_key"], r["utc_micros"]) for r in first) == [("1", micros(2024, 1, 1)), ("2", None), ("4", None)]
    assert d.table().count() == 3
    again = I.InstantDictionary(spark, d.path)  # as after a restart
    second = I.normalise(rows(spark, [("5", "2024-01-01T00:00:00Z", None), ("6", "2024-01-01T00:00:00Z", "Asia/Kolkata"), ("7", "2024-01-01", "Asia/Kolkata")]), again).collect()
    assert {r["row_key"]: r["utc_micros"] for r in second} == {"5": micros(2024, 1, 1), "6": micros(2024, 1, 1), "7": micros(2023, 12, 31, 18, 30)}
    assert again.table().count() == 5  # only what it lacked was parsed
    assert I.normalise(rows(spark, []), again).count() == 0
