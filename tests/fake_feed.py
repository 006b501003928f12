"""A feed client for tests: pages of a fixed list of rows; each request is written to a file."""

from __future__ import annotations

import json
import os
from datetime import datetime


def pages(country: str, token: str | None, path: str, size: int = 3) -> tuple[list[dict], str | None]:
    with open(os.path.join(path, "asked"), "a") as f:
        f.write(f"{country} {token}\n")
    with open(os.path.join(path, f"{country}.json")) as f:
        rows = json.load(f)
    at = int(token or 0)
    held = [{**r, "date": r["date"] and datetime.fromisoformat(r["date"])} for r in rows[at : at + size]]
    return held, str(at + size) if at + size < len(rows) else None


def lay_out(path, **feeds: list[tuple]) -> None:
    """Feeds of (id, date) by country."""
    for country, rows in feeds.items():
        (path / f"{country}.json").write_text(json.dumps([{"id": i, "rating": 5, "content": f"text {i}", "date": d} for i, d in rows]))
    (path / "asked").write_text("")


def asked(path) -> list[str]:
    return (path / "asked").read_text().split("\n")[:-1]
