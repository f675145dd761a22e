from __future__ import annotations

import contextlib
import io


def rows(df):
    """Rows as tuples, sorted (NULL first)."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(v)) for v in t])


def _explained(df, mode: str) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def plan(df) -> str:
    """The physical plan with all details of each node."""
    return _explained(df, "formatted")


def final_plan(df) -> str:
    """The plan that adaptive execution ended up with."""
    df.collect()
    return _explained(df, "simple").split("+- == Initial Plan ==")[0]
