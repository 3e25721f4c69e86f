"""Walks through landed pages, against a walk one page at a time."""

import random

from feedloom.operators import landed

SCHEMA = "domain string, since_id long, landed long, ids array<bigint>"


def walk(pages, limit, most):
    """Pages (domain, since_id, landed, ids): the walk of one domain, as a store is paged through."""
    out = []
    for domain in {p[0] for p in pages if p[0] is not None}:
        held = {}
        for _, since, at, ids in sorted((p for p in pages if p[0] == domain), key=lambda p: p[2]):
            held[since] = at, ids or []
        since = None
        for step in range(most):
            if since not in held:
                break
            at, ids = held[since]
            numbers = [i for i in ids if i is not None]
            after = numbers[-1] if numbers else None
            state = "empty" if not ids else "short" if len(ids) < limit else "no id" if after is None else "bound" if step + 1 == most else "more" if after in held else "unlanded"
            out.append((domain, step, since, at, len(ids), after, state))
            if state != "more":
                break
            since = after
    return sorted(out, key=repr)


def chains(frame, limit, most):
    return sorted(map(tuple, landed.page_chains(frame, limit, most).collect()), key=repr)


def test_golden_chains(spark):
    pages = [
        ("two", None, 1, [5, 9, 7]), ("two", 7, 2, [8]),  # on from the last id, not the largest
        ("empty", None, 3, [1, 2, 3]), ("empty", 3, 4, []),
        ("broken", None, 5, [1, 2, 3]), ("broken", 2, 6, [4]),
        ("no id", None, 7, [None, None, None]),
        ("mixed", None, 8, [4, None, None]), ("mixed", 4, 9, None),
        ("again", None, 10, [1, 2, 3]), ("again", None, 11, [1, 2, 6]), ("again", 3, 12, [7]), ("again", 6, 13, [8, 9]),
        ("round", None, 14, [1, 2, 3]), ("round", 3, 15, [1, 2, 3]),
        ("headless", 3, 16, [1]), (None, None, 17, [1]),
    ]
    got = chains(spark.createDataFrame(pages, SCHEMA), 3, 4)
    ends = {(r[0], r[1], r[6]) for r in got if r[6] != "more"}
    assert ends == {("two", 1, "short"), ("empty", 1, "empty"), ("broken", 0, "unlanded"), ("no id", 0, "no id"), ("mixed", 1, "empty"), ("again", 1, "short"), ("round", 3, "bound")}
    assert [r[3] for r in got if r[0] == "again"] == [11, 13] and [r[3] for r in got if r[0] == "round"] == [14, 15, 15, 15]
    assert got == walk(pages, 3, 4)
    assert landed.page_chains(spark.createDataFrame([], SCHEMA)).count() == 0


def test_random_chains(spark):
    rnd = random.Random(4)
    pages = []
    for at in range(400):
        ids = [rnd.choice([None, *range(8)]) for _ in range(rnd.choice([3, 3, 3, 3, 2, 0]))]
        pages.append((f"d{rnd.randrange(25)}", rnd.choice([None, *range(8)]), at, ids))
    assert chains(spark.createDataFrame(pages, SCHEMA).repartition(5), 3, 6) == walk(pages, 3, 6)


def test_products_in_order_of_the_walk(spark):
    rows = [("a", None, 1, [("x", 5), ("y", 3)]), ("a", 3, 2, [("z", 4)]), ("a", 9, 3, [("never", 1)])]
    frame = spark.createDataFrame(rows, "domain string, since_id int, landed long, products array<struct<title: string, id: bigint>>").selectExpr("*", "products.id AS ids")
    got = landed.chained_products(frame, landed.page_chains(frame, 2), limit=2).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [("a", 0, "x", 5), ("a", 1, "y", 3), ("a", 2, "z", 4)]
