"""Random changes to a versioned table against a plain dict, every version checked."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators.versions import VersionedTable

SCHEMA = "id int, country string, n int"
COUNTRIES = ["US", "IN", "GB", None]


def as_dict(df):
    found = [tuple(r) for r in df.select("id", "country", "n").collect()]
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: r[1:] for r in found}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_changes(spark, folder, seed):
    pick = random.Random(seed)
    state = {i: (pick.choice(COUNTRIES), pick.choice([None, *range(10)])) for i in range(30)}
    table = VersionedTable(spark, f"{folder}/t", ["country"])
    table.create(spark.createDataFrame([(k, *v) for k, v in state.items()], SCHEMA))
    states, next_id = [dict(state)], 30

    for kind in pick.sample(["update", "delete", "append", "merge", "compact", "update"], 6):
        limit, country = pick.randint(2, 8), pick.choice(COUNTRIES[:3])
        if kind == "update":
            hits = [k for k, (c, n) in state.items() if c == country and n is not None and n < limit]
            n_rows = table.update(
                (F.col("country") == country) & (F.col("n") < limit), {"n": F.col("n") + 10}
            )
            state |= {k: (state[k][0], state[k][1] + 10) for k in hits}
            assert n_rows == len(hits)
        elif kind == "delete":
            hits = [k for k, (_, n) in state.items() if n == limit]
            assert table.delete(F.col("n") == limit) == len(hits)
            for k in hits:
                del state[k]
        elif kind == "append":
            new = {next_id + i: (pick.choice(COUNTRIES), i) for i in range(5)}
            next_id += 5
            table.append(spark.createDataFrame([(k, *v) for k, v in new.items()], SCHEMA))
            state |= new
        elif kind == "merge":
            keys = [*pick.sample(sorted(state), 4), next_id]
            next_id += 1
            new = {k: (pick.choice(COUNTRIES), -k) for k in keys}
            table.merge(spark.createDataFrame([(k, *v) for k, v in new.items()], SCHEMA), ["id"])
            state |= new
        else:
            assert table.compact() == len(state)
        states.append(dict(state))

    for version, expected in enumerate(states):
        assert as_dict(table.as_of(version)) == expected, version
