"""Small results as JSON payloads."""

from __future__ import annotations

import datetime as dt
import json
import math

from pyspark.sql import DataFrame

#: Rows of a section at most; a section is a report, not a table.
MOST_ROWS = 10_000


def plain(value):
    """A JSON value: dates as text, NaN and infinities as null, decimals as numbers."""
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value if value is None or isinstance(value, (str, int, bool)) else float(value)


def payload(sections: dict[str, DataFrame]) -> str:
    """Sections of rows as one JSON text. A section with more than MOST_ROWS rows is refused, not cut."""
    out = {}
    for name, df in sections.items():
        rows = df.limit(MOST_ROWS + 1).collect()
        if len(rows) > MOST_ROWS:
            raise ValueError(f"section {name} has more than {MOST_ROWS} rows")
        out[name] = [plain(r.asDict(recursive=True)) for r in rows]
    return json.dumps(out, allow_nan=False)
