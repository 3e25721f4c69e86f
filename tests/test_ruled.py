"""Rules as a table, against the compiled ones."""

import random
import re

import pytest
from pyspark.sql import functions as F

from feedloom.functions import products, rules, text
from feedloom.operators import ruled

from .test_functions import JUNK

SCHEMA = "id long, title string, price double, kind string, tags array<string>"


def both(spark, rows):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    by_table = ruled.classified(frame, "id", F.col("title"), F.col("kind"), F.col("price"), ruled.built_in(spark), F.col("tags"))
    compiled = frame.select("id", products.is_junk(F.col("title"), F.col("price"), F.col("kind")).alias("junk"), text.infer_category(F.col("kind"), F.col("title")).alias("category"), text.infer_colors(F.col("title"), F.col("kind"), F.col("tags")).alias("color_tags"))
    return (sorted((r.id, r.junk, r.category, r.color_tags) for r in x.collect()) for x in (by_table, compiled))


def test_golden_junk_by_table(spark):
    got, want = both(spark, [(t, p, k, None) for t, p, k, _ in JUNK])
    assert [r[1] for r in got] == [j[3] for j in JUNK] and got == want


def test_random_texts(spark):
    """Keywords of all tables among other words, in the plural, glued together, and cut off."""
    rnd = random.Random(8)
    words = [*rules.JUNK_TITLE_PHRASES, *rules.JUNK_TYPE_PHRASES, *rules.JUNK_ADDON_WORDS, *[w for _, ws in rules.CATEGORY_RULES + rules.COLOR_RULES for w in ws]]

    def phrase():
        out = ""
        for _ in range(rnd.randrange(6)):
            w = rnd.choice([rnd.choice(words), rnd.choice(words), "plain", "café", "x1", "\U0001d518", ""])
            w = rnd.choice([w, w + "s", w + "es", w.title(), w + "x", w[1:], w.upper()])
            out += w + rnd.choice([" ", " ", "-", "", "  ", ", ", "é", "\n", "'s "])
        return out

    rows = [(phrase(), rnd.choice([1.0, 14.99, 15.0, 80.0, None]), rnd.choice([phrase(), "", None]), rnd.choice([None, [], [phrase(), phrase()]])) for _ in range(1500)]
    rows += [(None, None, None, None), ("", 1.0, "", []), ("word " * 20_000 + "navy dress", 100.0, "x", None)]
    got, want = both(spark, rows)
    assert got == want
    assert {r[1] for r in got} == {True, False} and len({r[2] for r in got}) == 6


def test_rules_change_without_code(spark):
    rows = spark.createDataFrame([(1, "a kite and a boat"), (2, "two boats"), (3, "kitesurf"), (4, None), (5, "boat+ kite")], "id long, t string")
    table = [("toy", "t", "word", 1, "kite", "kite"), ("toy", "t", "word", 2, "boat", "boat"), ("toy", "t", "word", 0, "boat plus", "boat+"), ("near", "t", "part", 0, "kite", "ite"), ("near", "t", "part", 1, "surf", "surf"), ("none", "t", "word", 0, "x", "")]
    hits = ruled.rule_hits(rows, "id", {"t": F.lower("t")}, spark.createDataFrame(table, ruled.RULES))
    assert {tuple(r) for r in ruled.first_labels(hits, "id").collect()} == {(1, "toy", "kite"), (1, "near", "kite"), (2, "toy", "boat"), (3, "near", "kite"), (5, "toy", "boat plus"), (5, "near", "kite")}
    assert {(r.id, r.label) for r in hits.where("name = 'near'").collect()} == {(1, "kite"), (3, "kite"), (3, "surf"), (5, "kite")}
    assert ruled.rule_hits(rows, "id", {"t": F.col("t")}, spark.createDataFrame([], ruled.RULES)).count() == 0
    with pytest.raises(ValueError):
        ruled.rule_hits(rows, "id", {"t": F.col("t")}, spark.createDataFrame([("a", "t", "word", 0, "b", "+one")], ruled.RULES))


def test_rules_of_a_file(spark, tmp_path):
    path = str(tmp_path / "rules.json")
    ruled.built_in(spark).coalesce(1).write.json(path)
    assert sorted(map(tuple, ruled.read_rules(spark, path).collect())) == sorted(map(tuple, ruled.built_in(spark).collect()))


def test_plan_is_the_same_for_any_rules(spark):
    """No pattern in the plan comes from a rule."""
    frame = spark.createDataFrame([(1, "a", 1.0, "b", None)], SCHEMA)
    few = [("color", "shown", "part", 0, "red", "red"), ("junk", "title", "word", 0, "junk", "refund")]
    shape = []
    for rows in (few, [*few, ("junk", "title", "word", 0, "junk", "fee"), ("color", "shown", "part", 1, "tan", "tan")]):
        hits = ruled.rule_hits(frame, "id", {"title": F.col("title"), "shown": F.col("title")}, spark.createDataFrame(rows, ruled.RULES))
        plan = hits._jdf.queryExecution().optimizedPlan().toString()
        assert "refund" not in plan and plan.count("RLIKE") == 1 and "Python" not in plan
        shape.append(re.sub(r"#\d+|\d+", "", plan))
    assert shape[0] == shape[1]


def test_places_stay_where_they_are(spark):
    """The places of a text meet the index where they are; very many rules, which are joined, give the same."""
    frame = spark.createDataFrame([(i, "plain words " * 200 + "a Navy dress, gift  card+ (b.c)") for i in range(4)], "id long, t string")
    table = spark.createDataFrame([("c", "t", "part", 0, "navy", "navy"), ("c", "t", "part", 1, "card", "rd+ (b.c"), ("w", "t", "word", 0, "dress", "dress")], ruled.RULES)
    bounds = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    try:
        for name, value in bounds.items():
            spark.conf.set(name, value)
        hits = ruled.rule_hits(frame, "id", {"t": F.lower("t")}, table)
        plan = hits._jdf.queryExecution().executedPlan()
        few = sorted(map(tuple, hits.collect()))
        assert "SortMergeJoin" not in plan.toString()
    finally:
        for name in bounds:
            spark.conf.unset(name)
    assert few == sorted((i, *r) for i in range(4) for r in [("c", 0, "navy"), ("c", 1, "card"), ("w", 0, "dress")])
    held = ruled.INDEX_SENT, ruled.INDEX_SOUGHT
    try:
        ruled.INDEX_SENT, ruled.INDEX_SOUGHT = 0, 0
        assert sorted(map(tuple, ruled.rule_hits(frame, "id", {"t": F.lower("t")}, table).collect())) == few
    finally:
        ruled.INDEX_SENT, ruled.INDEX_SOUGHT = held
