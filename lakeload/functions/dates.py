"""Slice dates: reading them out of file names, and choosing them with wildcards."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strftime part -> (digits, value when the format has no such part).
_DATE_PARTS = {
    "%Y": (4, ""),
    "%m": (2, "01"),
    "%d": (2, "01"),
    "%H": (2, "00"),
    "%M": (2, "00"),
    "%S": (2, "00"),
}


def date_regex(fmt: str) -> tuple[str, str]:
    """A strftime format such as ``%Y%m%d`` as a regular expression with one group per part, and
    the ISO timestamp in terms of those groups."""
    regex, groups = "", {}
    for token in re.findall(r"%.|[^%]+", fmt):
        if not token.startswith("%"):
            regex += re.escape(token)
        elif token in _DATE_PARTS:
            regex += rf"(\d{{{_DATE_PARTS[token][0]}}})"
            groups[token] = f"${len(groups) + 1}"
        else:
            raise ValueError(f"unsupported date part {token!r} in {fmt!r}")
    if "%Y" not in groups:
        raise ValueError(f"the date format needs %Y, got {fmt!r}")
    year, month, day, hour, minute, second = (
        groups.get(part, default) for part, (_, default) in _DATE_PARTS.items()
    )
    return regex, f"{year}-{month}-{day} {hour}:{minute}:{second}"


def _slice_date(text: Column, regex: str, iso: str) -> Column:
    # Casting ISO text is faster than parsing with a pattern. Text left as it is had no date.
    return F.nullif(F.regexp_replace(text, regex, iso), text).try_cast("timestamp")


def slice_date_from(name: Column, fmt: str = "%Y%m%d") -> Column:
    """The last date in a file name. A name without one gives null, so a stray file never fails a
    load."""
    regex, iso = date_regex(fmt)
    return _slice_date(name, rf"^.*(?<!\d){regex}.*$", iso)


def directory_slice_date(path: Column, name: Column, fmt: str = "%Y%m%d") -> Column:
    """The date that names a file's directory, as ``20230101`` or ``day=20230101``.

    Only the end of the directory is cut out and matched: this runs once per row, and matching
    whole paths would cost about as much as reading the row.
    """
    regex, iso = date_regex(fmt)
    width = sum(_DATE_PARTS[t][0] if t[0] == "%" else len(t) for t in re.findall(r"%.|[^%]+", fmt))
    start = F.length(path) - F.length(name) - width - 1
    return _slice_date(path.substr(start, F.lit(width + 1)), rf"^[/=]{regex}$", iso)


@dataclass(frozen=True)
class Timeslice:
    """A day, or a wildcard over days: ``2023-01-01``, ``2023-01-*``, ``2023-*-*``, ``*``."""

    year: str | int = "*"
    month: str | int = "*"
    day: str | int = "*"

    @classmethod
    def parse(cls, text: str) -> Timeslice:
        if text == "*":
            return cls()
        match = re.fullmatch(r"(\d{4}|\*)-(\d{1,2}|\*)-(\d{1,2}|\*)", text)
        if not match:
            raise ValueError(f"time slice must be yyyy-mm-dd with * allowed, got {text!r}")
        return cls(*match.groups())

    def to_glob(self, fmt: str = "%Y%m%d") -> str:
        """Glob for one path segment, so only matching directories and files are listed."""
        chosen = {"%Y": self.year, "%m": self.month, "%d": self.day}
        parts = {k: v if v == "*" else str(v).zfill(2) for k, v in chosen.items()}
        glob = re.sub(r"%.", lambda m: parts.get(m.group(), "*"), fmt)
        return re.sub(r"\*+", "*", glob)
