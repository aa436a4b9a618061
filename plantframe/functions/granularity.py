"""Granularity text such as ``1d``, ``12h``, ``day`` or ``7minute``."""

from __future__ import annotations

import re
from collections.abc import Iterable

from ..errors import PlantError

# Unit names and their length in seconds.
UNIT_SECONDS = {
    "s": 1,
    "m": 60,
    "h": 3600,
    "d": 86400,
    "w": 604800,
    "second": 1,
    "minute": 60,
    "hour": 3600,
    "day": 86400,
    "week": 604800,
}

_FORM = re.compile(rf"([1-9][0-9]*)?({'|'.join(UNIT_SECONDS)})")


def to_micros(text: str) -> int:
    """Length of one bucket in microseconds."""
    found = _FORM.fullmatch(text)
    if not found:
        raise PlantError(f"bad granularity {text}")
    return int(found[1] or 1) * UNIT_SECONDS[found[2]] * 1_000_000


def parse_all(texts: Iterable[str]) -> dict[str, int]:
    """Text to microseconds. Texts may hold several forms separated by ``|``; all errors are reported."""
    parsed: dict[str, int] = {}
    bad: list[str] = []
    for text in texts:
        for part in text.split("|"):
            try:
                parsed.setdefault(part, to_micros(part))
            except PlantError as error:
                bad.append(str(error))
    if bad:
        raise PlantError("\n".join(bad))
    return parsed
