"""Small hand-made files and rows."""

from __future__ import annotations

import json
from pathlib import Path

HEADER = "datetime,CellID,countrycode,smsin,smsout,callin,callout,internet"


def day_lines(date: str = "2013-11-01", hours: int = 24, values: str = "1,2,3,4,5", cell: str = "1") -> list[str]:
    return [f"{date} {h:02d}:00:00,{cell},39,{values}" for h in range(hours)]


def write_day(folder: Path, date: str, lines: list[str], header: str | None = HEADER, name: str | None = None) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / (name or f"sms-call-internet-mi-{date}.csv")
    path.write_text("".join(f"{line}\n" for line in ([header] if header else []) + lines))
    return path


def square(x: float, y: float) -> dict:
    ring = [[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]
    return {"type": "Polygon", "coordinates": [ring]}


def feature(cell, geometry) -> dict:
    properties = {} if cell is None else {"cellId": cell}
    return {"type": "Feature", "properties": properties, "geometry": geometry}


def write_geojson(path: Path, features: list[dict]) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    return str(path)
