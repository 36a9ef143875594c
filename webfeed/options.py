"""Read options: which deliveries to read, and argument checks.

A read selects deliveries by exactly one of: nothing (every delivery in the
directory), one ``date``, a list of ``dates``, or an inclusive ``start``/``end``
range. Dates are strict ISO ``yyyy-MM-dd``.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from .errors import FeedOptionError

# --- fixed values -----------------------------------------------------------
# Lookup tables shipped inside every delivery's lookup archive.
KNOWN_LOOKUPS = (
    "browser.tsv",
    "browser_type.tsv",
    "color_depth.tsv",
    "connection_type.tsv",
    "country.tsv",
    "event.tsv",
    "javascript_version.tsv",
    "languages.tsv",
    "operating_systems.tsv",
    "plugins.tsv",
    "referrer_type.tsv",
    "resolution.tsv",
    "search_engines.tsv",
)
# Archive member that holds the hit table's column names.
HEADER_MEMBER = "column_headers.tsv"
# ---------------------------------------------------------------------------

_ISO_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


def parse_date(text: str | date, what: str = "date") -> date:
    """Strict ``yyyy-MM-dd`` (no surrounding blanks, real calendar day)."""
    if isinstance(text, datetime):
        raise FeedOptionError(f"{what} must be a day, got a time: {text!r}")
    if isinstance(text, date):
        return text
    if not isinstance(text, str) or not _ISO_DATE.fullmatch(text):
        raise FeedOptionError(f"{what} must be yyyy-MM-dd, got {text!r}")
    try:
        return date.fromisoformat(text)
    except ValueError as e:
        raise FeedOptionError(f"{what} is not a calendar day: {text!r}") from e


@dataclass(frozen=True)
class DateSelection:
    """Exactly one way of choosing deliveries (or none = all available)."""

    date: date | None = None
    dates: tuple[date, ...] | None = None
    start: date | None = None
    end: date | None = None

    @property
    def kind(self) -> str:
        if self.date is not None:
            return "date"
        if self.dates is not None:
            return "dates"
        if self.start is not None:
            return "range"
        return "all"

    def expected_dates(self) -> list[date] | None:
        """Dates that must each have a delivery; None when reading everything."""
        if self.kind == "date":
            return [self.date]
        if self.kind == "dates":
            return sorted(self.dates)
        if self.kind == "range":
            n = (self.end - self.start).days
            return [self.start + timedelta(days=i) for i in range(n + 1)]
        return None


def selection(date: str | date | None = None,
              dates: str | Iterable[str | date] | None = None,
              start: str | date | None = None,
              end: str | date | None = None) -> DateSelection:
    """Check and build a :class:`DateSelection` (mutual exclusivity, order, uniqueness)."""
    given = [name for name, v in (("date", date), ("dates", dates)) if v is not None]
    if start is not None or end is not None:
        given.append("from/to")
    if len(given) > 1:
        raise FeedOptionError(f"choose one way to select dates, got {' and '.join(given)}")
    if (start is None) != (end is None):
        raise FeedOptionError("'from' and 'to' must be given together")

    if date is not None:
        return DateSelection(date=parse_date(date))
    if dates is not None:
        items = dates.split(",") if isinstance(dates, str) else list(dates)
        parsed = tuple(parse_date(d, "dates entry") for d in items)
        if not parsed:
            raise FeedOptionError("'dates' needs at least one date")
        if len(set(parsed)) != len(parsed):
            raise FeedOptionError("'dates' lists a date more than once")
        return DateSelection(dates=parsed)
    if start is not None:
        lo, hi = parse_date(start, "from"), parse_date(end, "to")
        if lo > hi:
            raise FeedOptionError(f"'from' {lo} is after 'to' {hi}")
        return DateSelection(start=lo, end=hi)
    return DateSelection()


def check_lookup_name(name: str) -> str:
    """The name of a known lookup table; suggests the closest one otherwise."""
    if name in KNOWN_LOOKUPS:
        return name
    near = difflib.get_close_matches(name, KNOWN_LOOKUPS, n=1)
    hint = f"; did you mean {near[0]!r}?" if near else ""
    raise FeedOptionError(f"unknown lookup {name!r}{hint} Known: {', '.join(KNOWN_LOOKUPS)}")


def parse_bool(value: object) -> bool:
    """``"true"`` in any case is true; everything else is false."""
    if isinstance(value, bool):
        return value
    return str(value).strip().lower() == "true"


@dataclass(frozen=True)
class ReadRequest:
    """A full read request as given through string options."""

    dir: str
    feedname: str
    selection: DateSelection
    validate: bool = False
    lookup: str | None = None


def request_from_options(options: Mapping[str, object], path: str | None = None) -> ReadRequest:
    """Build a :class:`ReadRequest` from reader options (keys are case-insensitive).

    Recognised keys: ``dir``, ``feedname``, ``date``, ``dates``, ``from``, ``to``,
    ``validate`` and ``path`` (the lookup name). Other keys are ignored.
    """
    opts = {str(k).lower(): v for k, v in options.items()}
    if path is not None:
        opts["path"] = path
    for key in ("dir", "feedname"):
        if not opts.get(key):
            raise FeedOptionError(f"option {key!r} is required")
    sel = selection(date=opts.get("date"), dates=opts.get("dates"),
                    start=opts.get("from"), end=opts.get("to"))
    lookup = opts.get("path")
    return ReadRequest(dir=str(opts["dir"]), feedname=str(opts["feedname"]), selection=sel,
                       validate=parse_bool(opts.get("validate", False)),
                       lookup=check_lookup_name(str(lookup)) if lookup is not None else None)
