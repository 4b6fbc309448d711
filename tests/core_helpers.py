"""Values and small functions that the tests of the core share."""

import json
from datetime import datetime, timezone


def utc(*parts) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


# Two points one day apart: 2023-05-08 and 2023-05-09, both at six in the morning UTC.
DAY1, DAY2 = 1683525600000, 1683612000000
TWO_POINTS = (
    f'{{"prices": [[{DAY1}, 12.5], [{DAY2}, 15.0]],'
    f' "market_caps": [[{DAY1}, 7100.0], [{DAY2}, 7350.0]],'
    f' "total_volumes": [[{DAY1}, 64.0], [{DAY2}, 81.0]]}}'
)


def payload(prices, caps=None, volumes=None) -> str:
    """JSON text with the given points; caps and volumes default to the prices."""
    return json.dumps(
        {
            "prices": prices,
            "market_caps": prices if caps is None else caps,
            "total_volumes": prices if volumes is None else volumes,
        }
    )


def rows(df, *columns):
    """Rows as plain tuples, ordered with nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])
