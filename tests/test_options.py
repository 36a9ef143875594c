from datetime import date

import pytest

from webfeed.errors import FeedOptionError
from webfeed.options import (KNOWN_LOOKUPS, check_lookup_name, parse_bool, request_from_options,
                             selection)


def test_no_selection_reads_everything():
    assert selection().kind == "all"
    assert selection().expected_dates() is None


def test_single_date():
    s = selection(date="2024-01-05")
    assert s.kind == "date" and s.expected_dates() == [date(2024, 1, 5)]


@pytest.mark.parametrize("kwargs", [
    dict(date="2024-01-01", dates="2024-01-02"),
    dict(date="2024-01-01", start="2024-01-01", end="2024-01-02"),
    dict(dates="2024-01-01", start="2024-01-01", end="2024-01-02"),
])
def test_selections_are_exclusive(kwargs):  # V8
    with pytest.raises(FeedOptionError):
        selection(**kwargs)


@pytest.mark.parametrize("kwargs", [dict(start="2024-01-01"), dict(end="2024-01-01")])
def test_range_needs_both_bounds(kwargs):  # V8
    with pytest.raises(FeedOptionError):
        selection(**kwargs)


def test_range_order_and_inclusive_bounds():  # V9, X2
    with pytest.raises(FeedOptionError):
        selection(start="2024-01-02", end="2024-01-01")
    assert selection(start="2024-01-03", end="2024-01-03").expected_dates() == [date(2024, 1, 3)]
    assert len(selection(start="2024-01-30", end="2024-02-02").expected_dates()) == 4


def test_date_list_unique_and_nonempty():  # V10
    with pytest.raises(FeedOptionError):
        selection(dates="2024-01-01,2024-01-01")
    with pytest.raises(FeedOptionError):
        selection(dates=[])
    assert selection(dates="2024-01-03,2024-01-01").expected_dates() == [date(2024, 1, 1), date(2024, 1, 3)]


@pytest.mark.parametrize("bad", ["2024-1-05", " 2024-01-05", "2024-01-05 ", "2024/01/05", "2024-02-30", ""])
def test_strict_iso_dates(bad):  # V12
    with pytest.raises(FeedOptionError):
        selection(date=bad)


def test_lookup_names():  # V11, X14
    assert len(KNOWN_LOOKUPS) == 13
    assert check_lookup_name("event.tsv") == "event.tsv"
    with pytest.raises(FeedOptionError, match="event.tsv"):
        check_lookup_name("events.tsv")
    with pytest.raises(FeedOptionError):
        check_lookup_name("column_headers.tsv")


def test_options_map():
    req = request_from_options({"DIR": "file:///x", "FeedName": "f", "Validate": "TRUE", "unknown": 1})
    assert req.validate and req.selection.kind == "all" and req.feedname == "f"
    # X7: validate given without a date is fine and does not imply a date
    req = request_from_options({"dir": "d", "feedname": "f", "validate": "false", "from": "2024-01-01",
                                "to": "2024-01-02"})
    assert not req.validate and req.selection.kind == "range"
    req = request_from_options({"dir": "d", "feedname": "f"}, path="browser.tsv")
    assert req.lookup == "browser.tsv"
    with pytest.raises(FeedOptionError):
        request_from_options({"feedname": "f"})


def test_parse_bool():
    assert parse_bool(True) and parse_bool("True") and not parse_bool("yes") and not parse_bool(None)


def test_a_time_is_no_day():  # W7
    from datetime import datetime

    with pytest.raises(FeedOptionError, match="a time"):
        selection(date=datetime(2024, 1, 5))
    with pytest.raises(FeedOptionError, match="a time"):
        selection(dates=[date(2024, 1, 5), datetime(2024, 1, 5, 3)])
