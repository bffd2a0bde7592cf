"""Writes weekly CSV folders with set modification times."""

from __future__ import annotations

import datetime as dt
import os
from pathlib import Path

STATE_HEADER = "FAB,WW,DAY_SHIFT,ENTITY_STATE,ENTITY,HOURS_IN_STATE,Total_Hours,% in State"


def write_csv(root: Path, week: str, name: str, lines: list[str], modified: dt.datetime, encoding="utf-8") -> Path:
    folder = root / week
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding) if lines else b"")
    stamp = modified.replace(tzinfo=dt.timezone.utc).timestamp()
    os.utime(path, (stamp, stamp))
    return path


def rows(df, *columns):
    """Selected columns as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=lambda row: [str(cell) for cell in row])
