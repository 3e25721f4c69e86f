"""Requests replayed from a log of their steps: what was legal, and how each one stood at any time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize

#: (step, from, to): what may happen to a request, "" before it is there. Steps that
#: leave a state as it is only stamp; the others lead on, never back.
TRANSITIONS = [
    ("submit", "", "pending"),
    ("review", "pending", "awaiting_review"),
    ("reject", "pending", "rejected"),
    ("email", "awaiting_review", "awaiting_review"),
    ("remint", "awaiting_review", "awaiting_review"),
    ("approve", "awaiting_review", "approved"),
    ("decline", "awaiting_review", "rejected"),
    ("add", "approved", "added"),
    ("notify", "added", "added"),
]


def _longest(transitions: Sequence[tuple[str, str, str]]) -> int:
    """The most steps that change a state, one after the other; an error if they may go on for ever."""
    after: dict[str, set[str]] = {}
    for _, a, b in transitions:
        if a != b:
            after.setdefault(a, set()).add(b)

    def depth(state: str, on: tuple[str, ...]) -> int:
        if state in on:
            raise ValueError(f"steps lead back to {state!r}")
        return max((1 + depth(b, (*on, state)) for b in after.get(state, ())), default=0)

    return max(depth(a, ()) for a in [*after, ""])


def _place(*columns: str) -> Column:
    return F.struct(*columns)


def timelines(log: DataFrame, transitions: Sequence[tuple[str, str, str]] = TRANSITIONS) -> DataFrame:
    """(id, place, state) of each change of a request's state: ``place`` is the step's (at, seq, step).

    ``log``: id, at, seq, step. Each round finds, for every request whose state can
    change yet, the first step after the last change that may change it: a
    minimum, which Spark combines before it shuffles, so that a request with
    very many steps is never one task's. There are as many rounds as changes on
    the longest way through.
    """
    steps = log.where("id IS NOT NULL AND at IS NOT NULL AND seq IS NOT NULL").select("id", "step", _place("at", "seq", "step").alias("place"))
    found: list[DataFrame] = []
    state: DataFrame | None = None
    for _ in range(_longest(transitions)):
        choices = lambda of: F.array(*[F.struct(F.lit(s).alias("step"), F.lit(b).alias("to")) for s, a, b in transitions if a == of and a != b])
        if state is None:
            begins = [s for s, a, b in transitions if a == "" and b != ""]
            to = reduce(lambda out, t: F.when(F.col("step") == t[0], t[2]).otherwise(out), [t for t in transitions if t[1] == ""], F.lit(None))
            ahead = steps.where(F.col("step").isin(begins)).select("id", "place", to.alias("to"))
        else:
            froms = {a for _, a, b in transitions if a != b and a}
            options = reduce(lambda out, of: F.when(F.col("state") == of, choices(of)).otherwise(out), sorted(froms), F.lit(None))
            wanted = state.select("id", F.col("place").alias("since"), F.explode(options).alias("c")).select("id", "since", "c.step", "c.to")
            ahead = steps.join(wanted, ["id", "step"]).where(F.col("place") > F.col("since")).select("id", "place", "to")
        state = materialize(ahead.groupBy("id").agg(F.min(F.struct("place", "to")).alias("s")).select("id", "s.place", F.col("s.to").alias("state")))
        found.append(state)
        if state.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def replayed(log: DataFrame, transitions: Sequence[tuple[str, str, str]] = TRANSITIONS) -> DataFrame:
    """Every step of ``log`` (id, at, seq, step, ...) with ``state_before``, ``legal`` and ``state_after``.

    Steps are in order of at, seq and step. One that isn't legal in the state in
    which it finds its request changes nothing. Rows that are alike in id, at,
    seq and step are one step that was logged again, and one row stands for them
    (any of them, if other columns differ). Steps of unknown names are never
    legal; those with a null id, time or number neither, with no state before.
    """
    keys = ["id", "at", "seq", "step"]
    known = log.where("id IS NOT NULL AND at IS NOT NULL AND seq IS NOT NULL")
    ways = timelines(known, transitions).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", "state"))).alias("x_way"))
    rows = log.dropDuplicates(keys).join(ways, "id", "left")
    place = _place("at", "seq", "step")
    before = F.element_at(F.concat(F.array(F.lit("")), F.transform(F.filter("x_way", lambda w: w["place"] < place), lambda w: w["state"])), -1)
    whole = F.col("id").isNotNull() & F.col("at").isNotNull() & F.col("seq").isNotNull()
    rows = rows.withColumn("state_before", F.when(whole, F.coalesce(before, F.lit(""))))
    to = reduce(lambda out, t: F.when((F.col("step") == t[0]) & (F.col("state_before") == t[1]), F.lit(t[2])).otherwise(out), transitions, F.lit(None).cast("string"))
    return rows.withColumn("x_to", to).withColumns({"legal": F.col("x_to").isNotNull(), "state_after": F.coalesce("x_to", "state_before")}).drop("x_way", "x_to")


def illegal(rows: DataFrame) -> DataFrame:
    """The steps of ``replayed`` that found their request in another state than they need."""
    return rows.where("NOT legal")


def states_at(rows: DataFrame, as_of: Column) -> DataFrame:
    """(id, status, processed_at, review_emailed_at, n_reminted, added_at, notified_at) of requests at a time, from ``replayed`` steps.

    Only requests that were there by then; of stamps set again the last counts.
    """
    done = rows.where(F.col("legal") & (F.col("at") <= as_of))
    when = lambda *steps: F.max(F.when(F.col("step").isin(*steps), F.col("at")))
    return done.groupBy("id").agg(
        F.max(F.struct("at", "seq", "step", "state_after"))["state_after"].alias("status"), when("review", "reject").alias("processed_at"), when("email").alias("review_emailed_at"),
        F.count_if(F.col("step") == "remint").alias("n_reminted"), when("add").alias("added_at"), when("notify").alias("notified_at"),
    )
