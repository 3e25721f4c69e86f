"""Rules as a table: which of them a row's texts meet, by an index of their words."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import blank, normalize_type

#: A keyword of a rule: of the keywords of one ``name`` those of the least ``rank`` come first.
#: ``mode`` is ``word`` (whole, or with s or es behind it) or ``part`` (anywhere).
RULES = "name string, field string, mode string, rank int, label string, keyword string"


def built_in(spark: SparkSession) -> DataFrame:
    """The library's own rules: junk, categories, colours."""
    rows = [("junk", "title", "word", 0, "junk", w) for w in rules.JUNK_TITLE_PHRASES]
    rows += [("junk", "kind", "word", 0, "junk", w) for w in rules.JUNK_TYPE_PHRASES]
    rows += [("cheap junk", "title", "word", 0, "junk", w) for w in rules.JUNK_ADDON_WORDS]
    rows += [("category", "both", "word", k, c, w) for k, (c, ws) in enumerate(rules.CATEGORY_RULES) for w in ws]
    rows += [(name, field, "part", k, c, w) for name, field in (("color", "shown"), ("color behind", "behind")) for k, (c, ws) in enumerate(rules.COLOR_RULES) for w in ws]
    return spark.createDataFrame(rows, RULES)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from JSON lines with the columns of RULES."""
    return spark.read.schema(RULES).json(path)


#: So many index entries at most are sent to every task, and looked for by one pattern a text; more are joined.
INDEX_SENT, INDEX_SOUGHT = 200_000, 2_000


def _index(table: DataFrame, gram: int) -> DataFrame:
    """Rules by the word that a text must have where the keyword begins: of a part, by its first ``gram`` characters."""
    first = F.regexp_extract("keyword", "^[a-z0-9]+", 0)
    # A keyword of one word may stand in the plural, so that the text's word is longer.
    words = F.when(first == F.col("keyword"), F.array(first, F.concat(first, F.lit("s")), F.concat(first, F.lit("es")))).otherwise(F.array(first))
    keys = F.when(F.col("mode") == "part", F.array(F.left("keyword", F.lit(gram)))).otherwise(words)
    return table.select("name", F.col("field").alias("r_field"), F.col("mode").alias("r_mode"), "rank", "label", "keyword", F.explode(keys).alias("r_key"))


def _sought(index: DataFrame) -> DataFrame:
    """(pattern, r_field, r_mode): one row of patterns for a field's and mode's keys, those of one first character together."""
    quoted = lambda c: F.regexp_replace(c, r"([^\p{L}\p{N}])", r"\\$1")
    keys = index.groupBy("r_field", "r_mode", F.left("r_key", F.lit(1)).alias("c")).agg(F.array_sort(F.collect_set(quoted(F.substr("r_key", F.lit(2))))).alias("rest"))
    heads = F.concat(quoted(F.col("c")), F.lit("(?:"), F.array_join("rest", "|"), F.lit(")"))
    return keys.groupBy("r_field", "r_mode").agg(F.array_join(F.array_sort(F.collect_list(heads)), "|").alias("keys"))


def rule_hits(df: DataFrame, key: str, texts: Mapping[str, Column], table: DataFrame) -> DataFrame:
    """(key, name, rank, label) of each rule that one of a row's lower-case ``texts`` meets, once a row and rule.

    ``table`` is as RULES says; its fields are names of ``texts``. Of each text
    the places where a word begins (for parts, all places) are looked up in an
    index of the keywords' beginnings, with as many characters behind them as
    the longest keyword has; what is found there is compared. The expressions
    are the same whatever the rules, and their number.

    ``key`` tells rows apart. Null and empty texts meet no rule, and rows that
    meet none are not in the result; neither are rules with an empty keyword. A
    keyword of mode ``word`` that begins with no letter a-z or digit is an error.
    """
    table = table.where(blank(F.col("keyword")) != "")
    sizes = table.agg(
        F.max(F.length("keyword")).alias("longest"), F.min(F.when(F.col("mode") == "part", F.length("keyword"))).alias("gram"), F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_set(F.struct("field", "mode"))).alias("used"), F.count_if((F.col("mode") == "word") & ~F.col("keyword").rlike("^[a-z0-9]")).alias("odd"),
    ).first()
    if sizes["odd"]:
        raise ValueError("a keyword to be found as a word begins with a letter a-z or a digit")
    length, gram, entries = (sizes["longest"] or 0) + 3, sizes["gram"] or 1, sizes["n"] * 3
    begins = {"word": ("(?s)(?<![a-z0-9])(?=((?:", f")(?![a-z0-9]).{{0,{length}}}))"), "part": ("(?s)(?=((?:", f").{{0,{length}}}))")}
    any_key = {"word": "[a-z0-9]+", "part": f".{{{gram}}}"}
    index = _index(table, gram)
    used = [(u["field"], u["mode"]) for u in sizes["used"]]
    key_of = lambda i, f, m: F.max(F.when((F.col("r_field") == f) & (F.col("r_mode") == m), F.col("keys"))).alias(f"x_keys{i}")
    if used and entries <= INDEX_SOUGHT:
        df = df.crossJoin(F.broadcast(_sought(index).agg(*[key_of(i, *u) for i, u in enumerate(used)])))
    else:
        df = df.withColumns({f"x_keys{i}": F.lit(any_key[mode]) for i, (_, mode) in enumerate(used)})

    def found(i: int, field: str, mode: str) -> Column:
        pattern = F.concat(F.lit(begins[mode][0]), F.col(f"x_keys{i}"), F.lit(begins[mode][1]))
        there = F.regexp_extract_all(blank(texts[field]), pattern, F.lit(1))
        return F.transform(there, lambda w: F.struct(F.lit(field).alias("field"), F.lit(mode).alias("mode"), w.alias("there")))

    places = [found(i, *u) for i, u in enumerate(used)]
    if not places:
        places = [F.array().cast("array<struct<field: string, mode: string, there: string>>")]
    rows = df.select(F.col(f"`{key}`").alias("key"), F.explode(F.concat(*places)).alias("p")).select("key", "p.*")
    looked = F.when(F.col("mode") == "part", F.left("there", F.lit(gram))).otherwise(F.regexp_extract("there", "^[a-z0-9]+", 0))
    rows = rows.withColumn("looked", looked)
    # Places are many times as long as the texts: they stay where they are, unless the rules are too many to send.
    index = F.broadcast(index) if entries <= INDEX_SENT else index
    # Boundaries of a word: one pattern, for all keywords.
    after = F.substr("there", F.length("keyword") + 1, F.lit(3)).rlike("^(?:s|es)?(?![a-z0-9])")
    met = rows.join(index, (F.col("looked") == F.col("r_key")) & (F.col("field") == F.col("r_field")) & (F.col("mode") == F.col("r_mode")))
    met = met.where(F.startswith("there", "keyword") & ((F.col("mode") == "part") | after))
    return met.groupBy("key", "name", "rank", "label").agg(F.count(F.lit(1)).alias("x")).select(F.col("key").alias(key), "name", "rank", "label")


def first_labels(hits: DataFrame, key: str) -> DataFrame:
    """(key, name, label): of each name the label of the least rank."""
    return hits.groupBy(key, "name").agg(F.min(F.struct("rank", "label")).alias("s")).select(key, "name", "s.label")


def classified(df: DataFrame, key: str, title: Column, product_type: Column, price: Column, table: DataFrame, tags: Column | None = None, options: Column | None = None) -> DataFrame:
    """(key, junk, category, color_tags) of products by a table of rules: what ``is_junk``, ``infer_category`` and ``infer_colors`` give by the built-in one.

    Rules are named junk, cheap junk, category, color and color behind, over
    the fields title, kind (the type's words), both (type and title), shown
    (title and type) and behind (tags and colour options).
    """
    low = F.lower(blank(title))
    joined = lambda a, b: F.lower(F.concat(blank(a), F.lit(" "), blank(b)))
    behind = F.lit("")
    if tags is not None:
        behind = F.concat(behind, F.lit(" "), blank(F.lower(F.array_join(tags, " "))))
    if options is not None:
        named = F.filter(F.coalesce(options, F.array()), lambda o: F.lower(blank(o["name"])).rlike("colou?r"))
        behind = F.concat(behind, F.lit(" "), blank(F.lower(F.array_join(F.flatten(F.transform(named, lambda o: F.coalesce(o["values"], F.array().cast("array<string>")))), " "))))
    texts = {"title": low, "kind": normalize_type(product_type), "both": joined(product_type, title), "shown": joined(title, product_type), "behind": behind}
    hits = rule_hits(df, key, texts, table)
    of = lambda name: F.when(F.col("name") == name, F.struct("rank", "label"))
    met = hits.groupBy(F.col(key).alias("x_key")).agg(
        F.bool_or(F.col("name") == "junk").alias("x_junk"), F.bool_or(F.col("name") == "cheap junk").alias("x_cheap"), F.min(of("category")).alias("x_category"),
        *[F.array_sort(F.collect_set(of(name))).alias(f"x_{c}") for c, name in (("shown", "color"), ("behind", "color behind"))],
    )
    rows = df.select(F.col(f"`{key}`").alias(key), (low == "").alias("x_empty"), F.coalesce(price < rules.JUNK_PRICE_FLOOR, F.lit(False)).alias("x_low"))
    colors = lambda c: F.slice(F.transform(c, lambda s: s["label"]), 1, rules.COLORS_KEPT)
    no = F.lit(False)
    return rows.join(met, F.col(key) == F.col("x_key"), "left").select(
        key,
        (F.col("x_empty") | F.coalesce("x_junk", no) | (F.col("x_low") & F.coalesce("x_cheap", no))).alias("junk"),
        F.coalesce("x_category.label", F.lit(rules.DEFAULT_CATEGORY)).alias("category"),
        F.when(F.size("x_shown") > 0, colors("x_shown")).when(F.size("x_behind") > 0, colors("x_behind")).otherwise(F.array(*map(F.lit, rules.DEFAULT_COLORS))).alias("color_tags"),
    )
