"""Verdict thresholds written in contracts."""

from __future__ import annotations

import re

# Duration unit letters -> seconds.
_UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def parse_duration(text: str | int | float) -> int:
    """T5: ``30s``, ``25h``, ``24h``, ``7d`` -> seconds (a bare number is seconds)."""
    if isinstance(text, (int, float)):
        return int(text)
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([smhdw]?)\s*", str(text).lower())
    if not m:
        raise ValueError(f"bad duration {text!r}")
    return int(float(m.group(1)) * _UNITS.get(m.group(2) or "s"))


def parse_share(text: str) -> tuple[str, float]:
    """``">95%"`` -> ("good_above", 0.95); ``"<5%"`` -> ("bad_below", 0.05).

    ``good_above`` maps to ``mostly`` (share of good rows), ``bad_below`` to
    ``mostly = 1 - share``."""
    m = re.fullmatch(r"\s*([<>])\s*(\d+(?:\.\d+)?)\s*%\s*", text)
    if not m:
        raise ValueError(f"bad share {text!r}")
    v = float(m.group(2)) / 100.0
    return ("good_above", v) if m.group(1) == ">" else ("bad_below", v)


def mostly_of(text: str) -> float:
    kind, v = parse_share(text)
    return v if kind == "good_above" else 1.0 - v


def parse_years(text: str) -> int:
    m = re.search(r"(\d+)\s*year", str(text), re.I)
    if not m:
        raise ValueError(f"bad retention period {text!r}")
    return int(m.group(1))
