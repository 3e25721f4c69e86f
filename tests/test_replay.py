"""Replay of requests, against a walk one step at a time."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import replay

SCHEMA = "id long, at long, seq long, step string"


def walk(log, transitions=replay.TRANSITIONS):
    """(id, at, seq, step, before, legal, after) of each step."""
    leads = {(s, a): b for s, a, b in transitions}
    out, state = [], {}
    for row in sorted({r for r in log if None not in r[:3]}, key=lambda r: (*r[:3], r[3] or "")):
        before = state.get(row[0], "")
        after = leads.get((row[3], before))
        out.append((*row, before, after is not None, before if after is None else after))
        state[row[0]] = out[-1][-1]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_logs(spark, seed):
    rnd = random.Random(seed)
    names = [s for s, _, _ in replay.TRANSITIONS] + ["seen"]
    log = [(rnd.randrange(30), rnd.randrange(40), rnd.randrange(3), rnd.choice(names)) for _ in range(900)]
    log += [(99, k, 0, "review") for k in range(500)] + [(99, 250, 0, "submit"), (99, 600, 0, "approve"), (99, 601, 0, "approve")] + log[:50]
    rows = replay.replayed(spark.createDataFrame(log, SCHEMA))
    assert sorted(map(tuple, rows.select("id", "at", "seq", "step", "state_before", "legal", "state_after").collect()), key=repr) == walk(log)
    for when in (10, 39, 1000):
        last = {}
        for r in sorted((r for r in walk(log) if r[5] and r[1] <= when), key=lambda r: r[:4]):
            last[r[0]] = r[6]
        assert {r.id: r.status for r in replay.states_at(rows, F.lit(when)).collect()} == last
    assert replay.illegal(rows).count() == sum(not r[5] for r in walk(log))


def test_awkward_logs(spark):
    log = [(1, 1, 1, "submit"), (1, None, 2, "review"), (None, 1, 1, "submit"), (1, 3, None, "review"), (2, 1, 1, None), (3, 1, 1, "add")]
    rows = replay.replayed(spark.createDataFrame(log, SCHEMA).withColumn("state_before", F.lit("x"))).collect()
    assert {(r.id, r.at, r.seq, r.step, r.state_before, r.legal) for r in rows} == {
        (1, 1, 1, "submit", "", True), (1, None, 2, "review", None, False), (None, 1, 1, "submit", None, False), (1, 3, None, "review", None, False), (2, 1, 1, None, "", False), (3, 1, 1, "add", "", False)
    }
    assert replay.replayed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_states_that_lead_back_are_refused(spark):
    with pytest.raises(ValueError):
        replay.timelines(spark.createDataFrame([], SCHEMA), [("go", "", "a"), ("on", "a", "b"), ("back", "b", "a")])
