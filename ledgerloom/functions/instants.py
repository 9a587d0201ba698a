"""Texts of times to instants: one parser for every form, precision and zone, used on distinct texts only."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

#: Zone abbreviations in their European meaning, in minutes east of Greenwich.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "UT": 0, "GMT": 0, "WET": 0,
    "BST": 60, "IST": 60, "WEST": 60, "CET": 60, "MET": 60,
    "CEST": 120, "MEST": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
MONTHS = {m: i for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}
_LONG = "january february march april may june july august september october november december".split()
_MONTH = r"(?P<mon>[A-Za-z]{3,9})\.?"
_CLOCK = r"(?P<h>\d{1,2})(?::(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d+))?)?)?\s*(?P<ap>[AaPp]\.?[Mm]\.?)?"
_ZONE = r"(?:\s*(?P<zone>[Zz]|[A-Za-z]{1,5}|(?:UTC|GMT|utc|gmt)?[+\-−]\d{1,2}(?::?\d{2})?(?::?\d{2})?|[A-Za-z]+(?:/[A-Za-z0-9_+\-]+)+))?(?:\s*[\[(](?P<name>[A-Za-z0-9_+\-/: ]+)[\])])?"
_DAY = r"(?:[A-Za-z]{3,9}\.?,?\s+)?"
_FORMS = [
    re.compile(p + r"\s*$")
    for p in (
        rf"(?P<y>\d{{4}})(?P<sep>[-/.])(?P<m>\d{{1,2}})(?P=sep)(?P<d>\d{{1,2}})(?:(?:[Tt_]|,?\s+)(?:at\s+)?{_CLOCK})?{_ZONE}",
        rf"(?P<y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}})[Tt\s](?P<h>\d{{2}}):?(?:(?P<mi>\d{{2}}):?(?:(?P<s>\d{{2}})(?:[.,](?P<f>\d+))?)?)?(?P<ap>(?!))?{_ZONE}",
        rf"(?P<d>\d{{1,2}})(?P<sep>[-/.])(?P<m>\d{{1,2}})(?P=sep)(?P<y>\d{{4}})(?:(?:[Tt]|,?\s+)(?:at\s+)?{_CLOCK})?{_ZONE}",
        rf"{_DAY}(?P<d>\d{{1,2}})(?:st|nd|rd|th)?[-\s/]+{_MONTH},?[-\s/]+(?P<y>\d{{4}})(?:(?:[Tt:]|,?\s+)(?:at\s+)?{_CLOCK})?{_ZONE}",
        rf"{_DAY}{_MONTH}\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<y>\d{{4}})(?:,?\s+(?:at\s+)?{_CLOCK})?{_ZONE}",
        rf"{_DAY}{_MONTH}\s+(?P<d>\d{{1,2}})\s+{_CLOCK}(?:\s+(?P<zone>[A-Za-z]{{3,5}}))?\s+(?P<y>\d{{4}})(?P<name>(?!))?",
    )
]
_NUMBER = re.compile(r"([+-]?)(\d+)(?:\.(\d*))?$")
_OFFSET = re.compile(r"(?:UTC|GMT)?([+\-−])(\d{1,2})(?::?(\d{2}))?(?::?(\d{2}))?$", re.I)
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


@lru_cache(maxsize=4096)
def zone_of(text: str | None):
    """The tzinfo that a zone text means: an offset, an abbreviation or a name; None if it means none."""
    text = (text or "").strip()
    if not text:
        return None
    if (minutes := ABBREVIATIONS.get(text.upper())) is not None:
        return timezone(timedelta(minutes=minutes))
    if m := _OFFSET.match(text):
        hours, minutes, seconds = int(m[2]), int(m[3] or 0), int(m[4] or 0)
        if hours > 23 or minutes > 59 or seconds > 59:
            return None
        size = timedelta(hours=hours, minutes=minutes, seconds=seconds)
        return timezone(size if m[1] == "+" else -size)
    for name in (text, "/".join(p.title() if p.islower() or p.isupper() else p for p in text.split("/")), text.title()):
        try:
            return ZoneInfo(name)
        except Exception:  # noqa: BLE001 - any failure to find the zone means that there is none
            continue
    return None


def utc_micros(text: str | None, source_zone: str | None = None) -> int | None:
    """Microseconds from 1970 of the instant that the text denotes, or None if it denotes none.

    An offset, zone name or abbreviation in the text decides, else source_zone, else UTC; an unknown source_zone counts as
    none. All-numeric dates that don't start with the year have the day first. A date alone is its local midnight. A bare
    number counts from 1970: up to 11 digits are seconds, up to 14 milliseconds, up to 17 microseconds, more nanoseconds. A wall
    time that occurs twice means the first, a skipped one is read with the offset before the change. Finer than microseconds is
    cut off. Null, blank, impossible dates and times (hour 24 and second 60 too), an unknown zone in the text, and any other text give None.
    """
    if text is None:
        return None
    text = text.strip()
    if m := _NUMBER.match(text):
        digits = len(m[2])
        scale = 1_000_000 if digits <= 11 else 1_000 if digits <= 14 else 1 if digits <= 17 else 0
        if digits > 20:
            return None
        value = int(m[2]) * scale if scale else int(m[2]) // 1000
        if m[3] and scale:
            value += int(m[3]) * scale // 10 ** len(m[3])
        value = -value if m[1] == "-" else value
        return value if -62_135_596_800_000_000 <= value <= 253_402_300_799_999_999 else None
    for form in _FORMS:
        if m := form.match(text):
            found = _instant(m.groupdict(), source_zone)
            if found is not None:
                return found
    return None


def _instant(g: dict, source_zone: str | None) -> int | None:
    if g.get("mon"):
        low = g["mon"].lower()
        month = MONTHS.get(low[:3])
        if month is None or not (_LONG[month - 1].startswith(low) or low == "sept"):
            return None
    else:
        month = int(g["m"])
    hour, minute, second = int(g.get("h") or 0), int(g.get("mi") or 0), int(g.get("s") or 0)
    if half := g.get("ap"):
        if not 1 <= hour <= 12:
            return None
        hour = hour % 12 + (12 if half[0] in "pP" else 0)
    elif g.get("h") and not g.get("mi") and g.get("sep"):
        return None  # a lone hour is a time only with am or pm, or in the compact form
    zone = None
    if g.get("zone") or g.get("name"):
        zone = zone_of(g.get("zone")) or zone_of(g.get("name"))
        if zone is None:
            return None
    zone = zone or zone_of(source_zone) or UTC
    try:
        wall = datetime(int(g["y"]), month, int(g["d"]), hour, minute, second, int(((g.get("f") or "") + "000000")[:6]), tzinfo=zone)
        return (wall.astimezone(UTC) - _EPOCH) // timedelta(microseconds=1)
    except (ValueError, OverflowError):
        return None
