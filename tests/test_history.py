"""Many days at once, against one day after the other."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import history, snapshots

DAY = dt.datetime(2024, 3, 1, 6)


def at(n):
    return DAY + dt.timedelta(days=n)


def fold(sightings, runs, days=7):
    """The catalog of each run from that of the run before: rows (id, brand, added, last seen) by run."""
    out, held = {}, {}
    for t in sorted(runs):
        live = {}
        for i, b, s in sightings:
            if s == t:
                live[i] = min(b, live.get(i, b))
        kept = {i: r for i, r in held.items() if i not in live and r[0] not in live.values() and t - r[2] <= dt.timedelta(days=days)}
        held = {i: (b, held[i][1] if i in held else t, t) for i, b in live.items()} | kept
        out[t] = dict(held)
    return out


def spans(by_run):
    """(id, brand, added, last seen, until) from the catalogs of all runs."""
    out = {}
    for t, rows in sorted(by_run.items()):
        for i, (brand, added, seen) in rows.items():
            out[i, added] = (i, brand, added, seen, t)
    return sorted(out.values())


def made(spark, sightings, runs):
    frame = spark.createDataFrame(sightings, "id string, brand string, at timestamp_ntz")
    rows = history.presence(frame, spark.createDataFrame([(t,) for t in runs], "at timestamp_ntz"))
    return sorted(tuple(r)[:5] for r in rows.collect())


@pytest.mark.parametrize("seed, density", [(1, 0.15), (2, 0.5), (3, 0.05)])
def test_presence_is_the_daily_fold(spark, seed, density):
    rnd = random.Random(seed)
    runs = [at(n) + dt.timedelta(hours=rnd.choice([0, 0, 3])) for n in range(60) if rnd.random() < 0.8]
    sightings = [(f"i{i}", f"b{i % 6 if rnd.random() < 0.95 else 0}", t) for t in runs for i in range(20) if rnd.random() < density]
    assert made(spark, sightings, runs) == spans(fold(sightings, runs))


def test_golden_spans(spark):
    runs = [at(n) for n in range(12)]
    sightings = [
        ("kept", "quiet", at(0)), ("kept", "quiet", at(7)),  # nothing of the brand for a week: one span
        ("lost", "other", at(0)), ("lost", "other", at(9)),  # more than seven days: gone, then new
        ("dropped", "busy", at(0)), ("fresh", "busy", at(1)), ("dropped", "busy", at(2)),  # its brand was seen without it
        ("once", "last", at(11)),
    ]
    want = [
        ("dropped", "busy", at(0), at(0), at(0)), ("dropped", "busy", at(2), at(2), at(9)), ("fresh", "busy", at(1), at(1), at(1)), ("kept", "quiet", at(0), at(7), at(11)),
        ("lost", "other", at(0), at(0), at(7)), ("lost", "other", at(9), at(9), at(11)), ("once", "last", at(11), at(11), at(11)),
    ]
    assert made(spark, sightings, runs) == want == spans(fold(sightings, runs))
    assert made(spark, [], runs) == []
    odd = [(None, "b", at(0)), ("x", None, at(0)), ("x", "b", None), ("x", "b", at(1)), ("x", "b", at(1)), ("x", "a", at(1))]
    assert made(spark, odd, [at(0), at(1)]) == [("x", "a", at(1), at(1), at(1))]


def test_presence_is_what_the_daily_operators_make(spark):
    """Three days through ``carried_forward`` and ``added_at``."""
    seen = [("a", "x", 0), ("b", "x", 0), ("c", "y", 0), ("c", "y", 1), ("a", "x", 2), ("d", "y", 2)]
    columns = "id string, brand string, name string, price int, last_seen_at timestamp, added_at timestamp"
    held = spark.createDataFrame([], columns)
    for n in range(3):
        live = spark.createDataFrame([(i, b, "Dress", 50, at(n), None) for i, b, d in seen if d == n], columns)
        day = F.lit(str(at(n))).cast("timestamp")
        every = live.unionByName(snapshots.carried_forward(live, held, day))
        held = spark.createDataFrame(snapshots.added_at(every, held, day).select(*held.columns).collect(), columns)
    rows = made(spark, [(i, b, at(n)) for i, b, n in seen], [at(n) for n in range(3)])
    assert sorted((r.id, r.added_at, r.last_seen_at) for r in held.collect()) == [(i, added, last) for i, _, added, last, until in rows if until == at(2)]


def walk(states, users):
    """Messages sent, one state after the other."""
    last, out = dict(users), []
    for user, t, sig in sorted((s for s in states if None not in s)):
        before, when = last.get(user, (None, None))
        if (when is None or when.date() != t.date()) and sig != before:
            out.append((user, t, sig))
            last[user] = (sig, t)
    return sorted(out), last


@pytest.mark.parametrize("seed", [1, 2])
def test_sends_are_a_fold(spark, seed):
    rnd = random.Random(seed)
    states = [(rnd.randrange(6), DAY + dt.timedelta(hours=rnd.randrange(24 * 20)), rnd.choice("abc")) for _ in range(700)]
    states += [(7, DAY, "a")] * 40 + [(7, DAY + dt.timedelta(days=1), "a")] * 40 + [(None, DAY, "a"), (8, None, "a"), (8, DAY, None)]
    before = {0: ("a", DAY), 1: (None, None), 2: ("b", DAY - dt.timedelta(days=3)), 3: ("c", DAY + dt.timedelta(days=4))}
    frame = spark.createDataFrame(states, "user_id long, at timestamp_ntz, signature string")
    users = spark.createDataFrame([(u, s, t) for u, (s, t) in before.items()], "id long, last_sig string, last_push_at timestamp_ntz")
    want, last = walk(states, before)
    sent = history.sends(frame, users)
    assert sorted(map(tuple, sent.collect())) == want
    assert {r.id: (r.last_sig, r.last_push_at) for r in history.stamps(sent, users).collect()} == {u: last[u] for u in before}
    assert sorted(map(tuple, history.sends(frame).collect())) == walk(states, {})[0]
    assert history.sends(frame.limit(0), users).count() == 0
