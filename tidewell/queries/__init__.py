"""The jobs' steps as named queries over the test tables, with SQL to check them against."""

from tidewell.queries import steps, stored
from tidewell.queries.oracle import all_oracles
from tidewell.queries.register import REGISTERED, Query


def all_queries() -> dict[str, Query]:
    return dict(REGISTERED)


__all__ = ["all_oracles", "all_queries", "steps", "stored"]
