"""Small helpers outside of frames: ranges, durations and log lines."""

from __future__ import annotations

import logging
import time
from datetime import timedelta


def partition(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """The inclusive range low..high as `parts` inclusive ranges of near-equal width, some maybe empty (end before start)."""
    if parts < 1:
        raise ValueError("at least one part is needed")
    size = high - low + 1
    cuts = [low + size * i // parts for i in range(parts + 1)]
    return [(a, b - 1) for a, b in zip(cuts, cuts[1:])]


def parse_duration(text: str) -> timedelta:
    """A whole number of milliseconds."""
    return timedelta(milliseconds=int(text))


def logger(label: str) -> logging.Logger:
    """A logger with lines of UTC time, label and message."""
    log = logging.getLogger(f"postmill.{label}")
    if not log.handlers:
        handler = logging.StreamHandler()
        form = logging.Formatter(f"[%(asctime)s] [{label}] %(message)s", "%H:%M:%S")
        form.converter = time.gmtime
        handler.setFormatter(form)
        log.addHandler(handler)
        log.setLevel(logging.INFO)
        log.propagate = False
    return log
