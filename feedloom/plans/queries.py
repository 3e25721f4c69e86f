"""One query for each operator over the driver's tables, with the same in SQL."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import links, money, products, rules, text, times, vectors
from ..operators import announce, digest, insights, neighbours, requests, selection, snapshots
from ..sources.tables import table, vector_payload

AS_OF = "2024-01-20 12:00:00"
SEED = "feed-1"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, folder) under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


# Pieces of SQL, from the same rule tables.


def sql_list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def sql_words(column: str, words: list[str]) -> str:
    """RE2 has no lookbehind; as a test for existence this is the same."""
    return f"regexp_matches({column}, '(^|[^a-z0-9])(?:{'|'.join(map(_escape, words))})(?:s|es)?($|[^a-z0-9])')"


def sql_parts(column: str, words: list[str]) -> str:
    return f"regexp_matches({column}, '{'|'.join(map(_escape, words))}')"


def _escape(word: str) -> str:
    return "".join("\\" + c if c in "+.()[]*?|^$" else c for c in word)


def sql_brand_key(c: str) -> str:
    return f"regexp_replace(translate(lower(coalesce({c}, '')), '{rules.ACCENTS[0]}', '{rules.ACCENTS[1]}'), '[^a-z0-9]', '', 'g')"


def sql_slug(c: str) -> str:
    return f"regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}]', '-', 'g'), '^-+|-+$', '', 'g')"


def sql_norm(c: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents(coalesce({c}, ''))), '[^a-z0-9]+', ' ', 'g'))"


def sql_category(c: str) -> str:
    return "CASE " + " ".join(f"WHEN {sql_words(c, w)} THEN '{k}'" for k, w in rules.CATEGORY_RULES) + f" ELSE '{rules.DEFAULT_CATEGORY}' END"


def sql_colors(c: str) -> str:
    tests = ", ".join(f"CASE WHEN {sql_parts(c, w)} THEN '{k}' END" for k, w in rules.COLOR_RULES)
    return f"list_filter([{tests}], lambda x: x IS NOT NULL)[1:{rules.COLORS_KEPT}]"


def sql_junk(title: str, price: str, kind: str) -> str:
    kind = f"trim(regexp_replace(lower({kind}), '[^a-z0-9]+', ' ', 'g'))"
    return (
        f"(lower({title}) = '' OR {sql_words(f'lower({title})', rules.JUNK_TITLE_PHRASES)} OR {sql_words(kind, rules.JUNK_TYPE_PHRASES)} "
        f"OR ({price} < {rules.JUNK_PRICE_FLOOR} AND {sql_words(f'lower({title})', rules.JUNK_ADDON_WORDS)}))"
    )


def sql_base(c: str) -> str:
    colors = "|".join(map(_escape, rules.color_words()))
    known = sql_list(rules.color_words())
    cuts = []
    for s in rules.SEPARATORS:
        tail = f"regexp_extract_all(substr(t, instr(t, '{s}') + {len(s)}), '[a-z]+')"
        cuts.append(f"WHEN instr(t, '{s}') > 0 AND len({tail}) > 0 AND (len({tail}) <= 2 OR len(list_filter({tail}, lambda w: NOT list_contains({known}, w))) = 0) THEN substr(t, 1, instr(t, '{s}') - 1)")
    inside = f"\\([^a-z)]*(?:(?:{colors})(?:[^a-z)]+(?:{colors}))*[^a-z)]*)?\\)|(\\([^)]*\\))"
    return (
        f"(SELECT coalesce(nullif(trim(regexp_replace(array_to_string(regexp_extract_all(regexp_replace(cut, '{inside}', '\\1', 'g'), '[a-z0-9'']+'), ' '), '(?:(?:^| )(?:{colors}))+$', '')), ''), trim(t)) "
        f"FROM (SELECT t, CASE {' '.join(cuts)} ELSE t END AS cut FROM (SELECT lower({c}) AS t)))"
    )


# Prices and sizes of what customers bought, as things saved, against the catalog of parts.

SIZES = ["XS", "S", "M", "L", "XL", "2XL"]
SPELLED = ["x-small", "Small", "medium", "L", "Extra Large", "xxl"]
_SQL_SAVED = f"""
WITH saved AS (
  SELECT o_custkey AS user_id, l_partkey AS pid, l_extendedprice / l_quantity AS was,
    {sql_list(SPELLED)}[1 + l_linenumber % 3 : 1 + l_linenumber % 3 + (l_suppkey % 4)] AS old_sizes,
    row_number() OVER (PARTITION BY o_custkey, l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_extendedprice, l_quantity) AS rn,
    row_number() OVER (PARTITION BY o_custkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity) AS pos
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), items AS (
  SELECT user_id, pid, pos, was, p_retailprice AS now, p_brand AS brand, p_name AS name, old_sizes,
    {sql_list(SIZES)}[1 + p_size % 3 : 1 + p_size % 3 + p_size % 4] AS live_sizes,
    p_retailprice < was AND (was - p_retailprice) / was * 100 >= 10 AND was - p_retailprice >= 3 AS sale
  FROM saved JOIN part ON p_partkey = pid WHERE rn = 1
)"""
_SQL_ALERTS = (
    _SQL_SAVED
    + f""", canon AS (
  SELECT *, list_transform(old_sizes, lambda s: coalesce(map_extract(M, lower(replace(replace(s, ' ', ''), '-', '')))[1], lower(s))) AS old_c,
    list_transform(live_sizes, lambda s: coalesce(map_extract(M, lower(s))[1], lower(s))) AS live_c
  FROM items, (SELECT MAP {{{", ".join(f"'{k}': '{v}'" for k, v in rules.SIZE_NAMES.items())}}} AS M)
), alerts AS (
  SELECT user_id, pid, pos, brand, name, CASE WHEN sale THEN was END AS was, CASE WHEN sale THEN now END AS now,
    CASE WHEN sale THEN trunc((was - now) / was * 100)::INT END AS pct,
    list_filter(live_sizes, lambda s, i: NOT list_contains(old_c, live_c[i])) AS new_sizes,
    list_filter(old_sizes, lambda s, i: NOT list_contains(live_c, old_c[i])) AS gone_sizes
  FROM canon
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(-pct, 1), -len(new_sizes), pos)::INT AS rank
  FROM alerts WHERE pct IS NOT NULL OR len(new_sizes) > 0 OR len(gone_sizes) > 0
)"""
)
_ITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]


def _saved(spark: SparkSession, folder: str) -> DataFrame:
    bought = table(spark, folder, "lineitem").join(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    sizes = F.slice(F.array(*map(F.lit, SPELLED)), F.col("l_linenumber") % 3 + 1, (F.col("l_suppkey") % 4 + 1).cast("int"))
    return bought.select(
        F.col("o_custkey").alias("user_id"), F.struct(*_ITEM_ORDER).alias("pos"), F.col("l_partkey").cast("string").alias("product_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_at_save"), F.lit(None).cast("string").alias("saved_id"), sizes.alias("saved_sizes"),
    )


def _live(spark: SparkSession, folder: str) -> DataFrame:
    sizes = F.slice(F.array(*map(F.lit, SIZES)), F.col("p_size") % 3 + 1, F.col("p_size") % 4 + 1)
    return table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"), sizes.alias("sizes"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"))


def _alerts(spark: SparkSession, folder: str) -> DataFrame:
    return digest.alerts(_saved(spark, folder), _live(spark, folder))


@query(
    _SQL_SAVED
    + """, drops AS (SELECT *, trunc((was - now) / was * 100)::INT AS pct FROM items WHERE sale)
SELECT user_id, pid::VARCHAR AS pid, brand, name, was, now, pct, row_number() OVER (PARTITION BY user_id ORDER BY -pct, pos)::INT AS rank FROM drops"""
)
def digest_price_drop(spark: SparkSession, folder: str) -> DataFrame:
    """Sales among saved items, ranked."""
    none = F.array().cast("array<string>")
    found = digest.alerts(_saved(spark, folder).withColumn("saved_sizes", none), _live(spark, folder))
    return found.select("user_id", "pid", "brand", "name", "was", "now", "pct", "rank")


@query(_SQL_ALERTS + " SELECT user_id, pid::VARCHAR AS pid, brand, name, was, now, pct, array_to_string(new_sizes, '|') AS new_sizes, array_to_string(gone_sizes, '|') AS gone_sizes, rank FROM ranked")
def digest_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Sales and size changes (F14 F15 J16), ranked."""
    return _alerts(spark, folder).select("user_id", "pid", "brand", "name", "was", "now", "pct", F.array_join("new_sizes", "|").alias("new_sizes"), F.array_join("gone_sizes", "|").alias("gone_sizes"), "rank")


_SQL_SUMMARY = (
    _SQL_ALERTS
    + """, parts AS (
  SELECT *, pid || ':' || CASE WHEN pct IS NOT NULL THEN 's' || printf('%g', now) ELSE '' END
    || CASE WHEN len(new_sizes) > 0 THEN '+' || array_to_string(list_sort(new_sizes), '|') ELSE '' END
    || CASE WHEN len(gone_sizes) > 0 THEN '-' || array_to_string(list_sort(gone_sizes), '|') ELSE '' END AS part, trim(brand || ' ' || name) AS label
  FROM ranked
), s AS (
  SELECT user_id, array_to_string(list_sort(list(part)), ';') AS signature, count(pct) AS n_sales, count(*) FILTER (pct IS NULL AND len(new_sizes) > 0) AS n_restocks,
    min_by({'label': label, 'pct': pct, 'now': now}, rank) FILTER (pct IS NOT NULL) AS sale,
    min_by({'label': label, 'size': new_sizes[1]}, rank) FILTER (pct IS NULL AND len(new_sizes) > 0) AS back
  FROM parts GROUP BY user_id
), summaries AS (
  SELECT user_id, signature, n_sales, n_restocks,
    CASE WHEN n_sales > 0 THEN 'Price drop among your saved items ✦' WHEN n_restocks > 0 THEN 'Back in your size ✦' END AS title,
    CASE WHEN n_sales > 0 THEN sale.label || ' is ' || sale.pct || '% off (now $' || printf('%g', sale.now) || ').'
      || CASE WHEN n_sales > 1 THEN ' +' || (n_sales - 1) || ' more on sale' WHEN n_restocks > 0 THEN ' +' || n_restocks || ' back in your size' ELSE '' END
    WHEN n_restocks > 0 THEN back.label || ' is back in ' || back.size || '.' || CASE WHEN n_restocks > 1 THEN ' +' || (n_restocks - 1) || ' more restocked' ELSE '' END END AS body
  FROM s
)"""
)


@query(_SQL_SUMMARY + " SELECT * FROM summaries")
def digest_summary(spark: SparkSession, folder: str) -> DataFrame:
    """One signature and one message a user."""
    return digest.summaries(_alerts(spark, folder))


def _users(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as users, with stamps that follow from their keys."""
    stamp = lambda n, m: as_of() - F.make_dt_interval(days=F.col("c_custkey").cast("int") % n, hours=F.col("c_custkey").cast("int") % m)
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 11 != 0, F.concat(F.lit("ExponentPushToken["), "c_custkey", F.lit("]"))).alias("token"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit("")).alias("last_sig"), stamp(5, 23).alias("last_push_at"), stamp(9, 5).alias("active_at"),
    )


_SQL_USERS = f"""(SELECT c_custkey AS id, CASE WHEN c_custkey % 11 <> 0 THEN 'ExponentPushToken[' || c_custkey || ']' END AS token, CASE WHEN c_custkey % 7 = 0 THEN '' END AS last_sig,
  TIMESTAMP '{AS_OF}' - to_days((c_custkey % 5)::INT) - to_hours((c_custkey % 23)::INT) AS last_push_at, TIMESTAMP '{AS_OF}' - to_days((c_custkey % 9)::INT) - to_hours((c_custkey % 5)::INT) AS active_at FROM customer)"""
_SQL_DUE = f"token IS NOT NULL AND last_push_at::DATE <> DATE '{AS_OF[:10]}' AND NOT active_at > TIMESTAMP '{AS_OF}' - INTERVAL 2 DAY"


@query(f"SELECT id, token FROM {_SQL_USERS} WHERE {_SQL_DUE}")
def digest_send_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Users that may get a message."""
    return digest.due(_users(spark, folder), as_of()).select("id", "token")


@query(_SQL_SUMMARY + f" SELECT user_id, token AS \"to\", title, body, signature FROM summaries JOIN {_SQL_USERS} u ON u.id = user_id WHERE title IS NOT NULL AND {_SQL_DUE} AND signature IS DISTINCT FROM last_sig")
def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Messages to send."""
    return digest.digests(_users(spark, folder), _alerts(spark, folder), as_of()).drop("last_push_at")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, trunc(CASE WHEN l_extendedprice * (1 - l_discount) < l_extendedprice AND l_extendedprice > 0 THEN (l_extendedprice - l_extendedprice * (1 - l_discount)) / l_extendedprice * 100 ELSE 0 END)::INT AS pct FROM lineitem")
def sale_percent(spark: SparkSession, folder: str) -> DataFrame:
    """F16."""
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", money.sale_percent(F.col("l_extendedprice") * (1 - F.col("l_discount")), F.col("l_extendedprice")).alias("pct"))


@query("SELECT o_orderkey, printf('%g', o_totalprice) AS price FROM orders")
def price_text(spark: SparkSession, folder: str) -> DataFrame:
    """F17."""
    return table(spark, folder, "orders").select("o_orderkey", money.price_text(F.col("o_totalprice")).alias("price"))


# Text rules.


@query(f"SELECT p_partkey, {sql_junk('p_name', 'p_retailprice % 40', 'p_type')} AS junk FROM part")
def junk_filter(spark: SparkSession, folder: str) -> DataFrame:
    """P2 F1."""
    return table(spark, folder, "part").select("p_partkey", products.is_junk(F.col("p_name"), F.col("p_retailprice") % 40, F.col("p_type")).alias("junk"))


@query(f"SELECT doc_id, {sql_words('lower(text)', ['the', 'une', 'der', 'las', 'return'])} AS found FROM documents")
def word_match(spark: SparkSession, folder: str) -> DataFrame:
    """P1."""
    return table(spark, folder, "documents").select("doc_id", text.has_word(F.lower("text"), ["the", "une", "der", "las", "return"]).alias("found"))


@query(f"SELECT p_partkey, {sql_category("lower(p_type || ' ' || p_name)")} AS category FROM part")
def infer_category(spark: SparkSession, folder: str) -> DataFrame:
    """F5."""
    return table(spark, folder, "part").select("p_partkey", text.infer_category(F.col("p_type"), F.col("p_name")).alias("category"))


@query(
    f"""SELECT p_partkey, array_to_string(CASE WHEN len(shown) > 0 THEN shown WHEN len(behind) > 0 THEN behind ELSE ['neutral'] END, ',') AS colors
FROM (SELECT p_partkey, {sql_colors("lower(p_name || ' ' || p_type)")} AS shown, {sql_colors("lower(p_brand || ' ' || p_name)")} AS behind FROM part)"""
)
def infer_colors(spark: SparkSession, folder: str) -> DataFrame:
    """the title comes first; brand and option values are behind it."""
    options = F.array(F.struct(F.lit("Colour").alias("name"), F.lit(1).alias("position"), F.array("p_name").alias("values")))
    colors = text.infer_colors(F.col("p_name"), F.col("p_type"), F.array("p_brand"), options)
    return table(spark, folder, "part").select("p_partkey", F.array_join(colors, ",").alias("colors"))


@query(f"SELECT doc_id, {sql_brand_key('text')} AS brand_key, {sql_slug('text')} AS slug, {sql_norm('text')} AS name, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS type FROM documents")
def names_normalized(spark: SparkSession, folder: str) -> DataFrame:
    """F1 F2 F3 F4, on whole texts."""
    heading = F.col("text")
    return table(spark, folder, "documents").select("doc_id", text.brand_key(heading).alias("brand_key"), text.slugify(heading).alias("slug"), text.normalize_name(heading).alias("name"), text.normalize_type(heading).alias("type"))


@query(f"SELECT p_partkey, {sql_slug('p_brand')} || '-' || p_partkey AS id FROM part")
def product_id(spark: SparkSession, folder: str) -> DataFrame:
    """F28."""
    return table(spark, folder, "part").select("p_partkey", F.concat(text.slugify(F.col("p_brand")), F.lit("-"), "p_partkey").alias("id"))


_VARIANT_NAMES = ["{} - Navy", "{} in Deep Red", "{} (Tan)", "{} (2)", "{}", "{} / one two three", "{} — Off White"]
_SQL_VARIANT = "CASE p_partkey % 7 " + " ".join(f"WHEN {k} THEN '{v.split('{}')[0]}' || p_name || '{v.split('{}')[1]}'" for k, v in enumerate(_VARIANT_NAMES)) + " END"


def _variant_name() -> Column:
    out = F.lit(None).cast("string")
    for k, v in enumerate(_VARIANT_NAMES):
        out = F.when(F.col("p_partkey") % 7 == k, F.concat("p_name", F.lit(v.removeprefix("{}")))).otherwise(out)
    return out


@query(f"SELECT p_partkey, {sql_base('title')} AS base FROM (SELECT p_partkey, {_SQL_VARIANT} AS title FROM part)")
def base_name(spark: SparkSession, folder: str) -> DataFrame:
    """F7, on names with colours behind them."""
    return table(spark, folder, "part").select("p_partkey", text.base_name(_variant_name()).alias("base"))


@query("SELECT doc_id, replace(replace(replace(replace(source || '<\"' || lang || '&', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS html FROM documents")
def escape_html(spark: SparkSession, folder: str) -> DataFrame:
    """F33."""
    return table(spark, folder, "documents").select("doc_id", text.escape_html(F.concat("source", F.lit('<"'), "lang", F.lit("&"))).alias("html"))


# Prices, sizes, images.


def _rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(pa.table({"currency": list(rules.FX_TO_USD), "fx": list(rules.FX_TO_USD.values())}))


_CURRENCIES = [*list(rules.FX_TO_USD)[:6], "XXX"]
_SQL_FX = "(VALUES " + ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in rules.FX_TO_USD.items()) + ") AS f(currency, fx)"


def _currency(key: str) -> Column:
    return F.get(F.array(*map(F.lit, _CURRENCIES)), (F.col(key) % len(_CURRENCIES)).cast("int"))


@query(f"SELECT p_partkey, round_even(p_retailprice * coalesce(fx, 1.0), 0)::INT AS price FROM (SELECT *, {sql_list(_CURRENCIES)}[1 + p_partkey % {len(_CURRENCIES)}] AS c FROM part) LEFT JOIN {_SQL_FX} ON c = f.currency")
def fx_price(spark: SparkSession, folder: str) -> DataFrame:
    """F11 J1 T1."""
    priced = table(spark, folder, "part").withColumn("currency", _currency("p_partkey")).join(_rates(spark), "currency", "left")
    return priced.select("p_partkey", products.usd(F.col("p_retailprice"), F.col("fx")).alias("price"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 0.0 WHEN p_partkey % 3 = 1 THEN p_retailprice END AS price FROM part")
def first_price(spark: SparkSession, folder: str) -> DataFrame:
    """"0.00" counts, "" and text don't."""
    price = lambda x: F.struct(x.alias("price"))
    variants = F.array(price(F.lit("")), price(F.lit("n/a")), price(F.when(F.col("p_partkey") % 3 == 0, "0.00").when(F.col("p_partkey") % 3 == 1, F.col("p_retailprice").cast("string"))))
    return table(spark, folder, "part").select("p_partkey", products.first_price(variants).alias("price"))


def _sold(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with a size option, and as variants what was sold of them."""
    item = F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_returnflag")
    value = lambda v: F.get(F.array(*map(F.lit, ["L", " S ", "2XL", "M", "xs"])), v["l_linenumber"] % 5)
    number = lambda v: F.concat(F.lit("eu "), (v["l_suppkey"] % 9 + 34).cast("string"))
    # Of what was sold in one size, or came back, the first is enough.
    size = F.when(F.col("l_partkey") % 2 == 0, F.col("l_linenumber") % 5).otherwise(F.col("l_suppkey") % 9)
    firsts = table(spark, folder, "lineitem").groupBy("l_partkey", size.alias("size"), (F.col("l_returnflag") == "R").alias("back")).agg(F.min(item).alias("item"))
    sold = firsts.groupBy("l_partkey").agg(F.array_sort(F.collect_list("item")).alias("v"))
    variant = lambda v: F.struct(v["l_extendedprice"].cast("string").alias("price"), (v["l_returnflag"] != "R").alias("available"), F.lit("x").alias("option1"), F.when(F.col("l_partkey") % 2 == 0, value(v)).otherwise(number(v)).alias("option2"), F.lit(None).cast("string").alias("option3"))
    declared = F.array(*[F.lit(f"eu {n}") for n in (40, 38, 36, 34, 42)])
    options = F.array(F.struct(F.lit("Color").alias("name"), F.lit(1).alias("position"), F.array(F.lit("x")).alias("values")), F.struct(F.lit(" SIZE ").alias("name"), F.lit(2).alias("position"), declared.alias("values")))
    return sold.select("l_partkey", F.transform("v", variant).alias("variants"), options.alias("options"))


@query(
    f"""
WITH v AS (
  SELECT l_partkey, CASE WHEN l_partkey % 2 = 0 THEN trim(['L', ' S ', '2XL', 'M', 'xs'][1 + l_linenumber % 5]) ELSE 'eu ' || (l_suppkey % 9 + 34) END AS s,
    row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_returnflag) AS i, l_returnflag
  FROM lineitem
), d AS (SELECT l_partkey, s, min(i) AS i FROM v WHERE l_returnflag <> 'R' GROUP BY ALL),
r AS (SELECT l_partkey, s, i, map_extract(MAP {{{", ".join(f"'{k}': {v}" for k, v in rules.SIZE_RANKS.items())}}}, upper(s))[1] AS rank, list_position(['eu 40', 'eu 38', 'eu 36', 'eu 34', 'eu 42'], s) AS place FROM d),
o AS (SELECT l_partkey, array_to_string(list(s ORDER BY CASE WHEN l_partkey % 2 = 0 THEN rank ELSE coalesce(nullif(place, 0), 100) END, i), ',') AS sizes FROM r GROUP BY l_partkey)
SELECT DISTINCT v.l_partkey, coalesce(sizes, '') AS sizes FROM v LEFT JOIN o USING (l_partkey)
"""
)
def available_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Letter sizes by scale, others as declared."""
    return _sold(spark, folder).select("l_partkey", F.array_join(products.available_sizes(F.col("options"), F.col("variants")), ",").alias("sizes"))


_IMAGES = ["", "https://i/a{}", "https://i/b{}", "https://i/a{}", "https://i/c{}", "https://i/d{}", "https://i/e{}", "https://i/f{}"]


def _images() -> Column:
    urls = [F.struct((F.concat(F.lit(u.removesuffix("{}")), (F.col("p_partkey") % (3 + k)).cast("string")) if u else F.lit("")).alias("src")) for k, u in enumerate(_IMAGES)]
    return F.array(*urls, F.struct(F.lit(None).cast("string").alias("src")))


@query(
    "SELECT p_partkey, l[1] AS hero, array_to_string(l[1:5], ' ') AS images FROM (SELECT p_partkey, list_filter(u, lambda x, i: x <> '' AND list_position(u, x) = i) AS l FROM (SELECT p_partkey, ["
    + ", ".join(f"'{u.removesuffix('{}')}' || (p_partkey % {3 + k})" if u else "''" for k, u in enumerate(_IMAGES))
    + "] AS u FROM part))"
)
def gallery(spark: SparkSession, folder: str) -> DataFrame:
    """F8 F9."""
    return table(spark, folder, "part").select("p_partkey", products.first_image(_images()).alias("hero"), F.array_join(products.gallery(_images()), " ").alias("images"))


# Selection.


def _feed(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as products of stores: a brand is a store, a part's key its place in the feed."""
    return table(spark, folder, "part").select(F.col("p_brand").alias("store_order"), F.col("p_partkey").alias("pos"), F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), text.base_name(F.col("p_name")).alias("base"))


@query(
    f"""SELECT store_order, id FROM (SELECT *, row_number() OVER (PARTITION BY store_order ORDER BY id) AS n FROM (
  SELECT p_brand AS store_order, p_partkey AS id, row_number() OVER (PARTITION BY p_brand, {sql_base("p_name")} ORDER BY p_partkey) AS b FROM part) WHERE b <= 2) WHERE n <= 15"""
)
def brand_cap(spark: SparkSession, folder: str) -> DataFrame:
    """Within the cap of variants, then of the store."""
    return selection.select_products(_feed(spark, folder).withColumn("cap", F.lit(15)), most=15).select("store_order", "id")


@query(f"SELECT s_suppkey, CASE WHEN list_contains({sql_list(text.brand_keys(rules.MAINSTREAM_BRANDS))}, {sql_brand_key('name')}) THEN 15 ELSE 60 END AS cap, {sql_brand_key('name')} = 'taottao' AS excluded FROM (SELECT s_suppkey, ['The  Row!', 'Totême', 'TAO-TTAO', s_name][1 + s_suppkey % 4] AS name FROM supplier)")
def effective_cap(spark: SparkSession, folder: str) -> DataFrame:
    """F30 P4."""
    name = F.get(F.array(F.lit("The  Row!"), F.lit("Totême"), F.lit("TAO-TTAO"), F.col("s_name")), (F.col("s_suppkey") % 4).cast("int"))
    return table(spark, folder, "supplier").select("s_suppkey", selection.effective_cap(name).alias("cap"), selection.is_excluded(name).alias("excluded"))


@query(f"SELECT store, id, round::INT AS round, md5('{SEED}|' || store || '|' || round) AS turn FROM (SELECT p_brand AS store, p_partkey AS id, row_number() OVER (PARTITION BY p_brand ORDER BY md5('{SEED}' || p_partkey), p_partkey) AS round FROM part)")
def interleave(spark: SparkSession, folder: str) -> DataFrame:
    """W4."""
    return selection.interleave(_feed(spark, folder).select(F.col("brand").alias("store"), "id"), "store", "id", SEED)


@query("SELECT min(p_partkey) AS id FROM part GROUP BY lower(trim(p_brand)), lower(trim(p_name))")
def name_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """D1."""
    return selection.name_repeats_removed(_feed(spark, folder), ["pos"]).select("id")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def last_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Of rows with one key the last."""
    return selection.keep_last(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query(f"SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // {rules.PUSH_BATCH} AS batch_no FROM customer")
def push_batches(spark: SparkSession, folder: str) -> DataFrame:
    """K6: batches of 100 rows in order."""
    return selection.batch_numbers(table(spark, folder, "customer").select("c_custkey"), "c_custkey")


# Snapshots.


def _days(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Parts as yesterday's and as today's catalog: some brands, and some parts of the others, are gone or new."""
    part = table(spark, folder, "part")
    number = F.col("p_partkey").cast("int")
    row = part.select(
        F.col("p_partkey").alias("id"), F.concat("p_brand", (number % 4).cast("string")).alias("brand"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"),
        F.when(number % 5 != 0, as_of() - F.make_dt_interval(days=number % 12)).alias("last_seen_at"),
        F.when(number % 3 != 0, as_of() - F.make_dt_interval(days=number % 40)).alias("added_at"),
    )
    return row.where("id % 9 < 7"), row.where("id % 4 > 0 AND id % 6 > 1").drop("last_seen_at", "added_at")


_SQL_DAYS = f"""
WITH r AS (SELECT p_partkey AS id, p_brand || (p_partkey % 4) AS brand, p_name AS name, p_retailprice AS price,
  CASE WHEN p_partkey % 5 <> 0 THEN TIMESTAMP '{AS_OF}' - to_days((p_partkey % 12)::INT) END AS last_seen_at,
  CASE WHEN p_partkey % 3 <> 0 THEN TIMESTAMP '{AS_OF}' - to_days((p_partkey % 40)::INT) END AS added_at FROM part),
prev AS (SELECT * FROM r WHERE id % 9 < 7), cur AS (SELECT id, brand, name, price FROM r WHERE id % 4 > 0 AND id % 6 > 1)"""


@query(_SQL_DAYS + f" SELECT id, brand FROM prev WHERE brand NOT IN (SELECT trim(brand) FROM cur) AND id NOT IN (SELECT id FROM cur) AND coalesce(last_seen_at, added_at) >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND NOT {sql_junk('name', 'price', chr(39) * 2)}")
def grace_carry(spark: SparkSession, folder: str) -> DataFrame:
    """B3 J4 J5 P11."""
    previous, current = _days(spark, folder)
    return snapshots.carried_forward(current, previous, as_of()).select("id", "brand")


@query(_SQL_DAYS + f" SELECT count(DISTINCT brand) AS labels, count(*) AS items FROM prev WHERE brand NOT IN (SELECT brand FROM cur) AND id NOT IN (SELECT id FROM cur) AND coalesce(last_seen_at, added_at) >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND NOT {sql_junk('name', 'price', chr(39) * 2)}")
def grace_counts(spark: SparkSession, folder: str) -> DataFrame:
    """A11."""
    previous, current = _days(spark, folder)
    return snapshots.carried_counts(snapshots.carried_forward(current, previous, as_of()))


@query(_SQL_DAYS + f" SELECT c.id, strftime(CASE WHEN p.added_at IS NOT NULL THEN p.added_at WHEN p.id IS NOT NULL THEN TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY ELSE TIMESTAMP '{AS_OF}' END, '%Y-%m-%dT%H:%M:%SZ') AS added_at FROM cur c LEFT JOIN prev p USING (id)")
def added_at(spark: SparkSession, folder: str) -> DataFrame:
    """B5 J6 F31."""
    previous, current = _days(spark, folder)
    return snapshots.added_at(current, previous, as_of()).select("id", times.iso(F.col("added_at")).alias("added_at"))


_DROPPED = "p_partkey % 5 < 2 AND p_size > 12"


@query(
    f"""WITH m AS (SELECT p_partkey AS id, p_brand || (p_partkey % 5) AS brand, {_DROPPED} AS gone FROM part),
b AS (SELECT brand, avg(gone::INT) > 0.40 OR (SELECT avg(gone::INT) FROM m) > 0.40 AS doubt FROM m GROUP BY brand)
SELECT id, brand, NOT doubt AS validated FROM m JOIN b USING (brand) WHERE doubt OR NOT gone"""
)
def drop_guard(spark: SparkSession, folder: str) -> DataFrame:
    """B4 A3 A4."""
    rows = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.concat("p_brand", (F.col("p_partkey") % 5).cast("string")).alias("brand"), F.expr(_DROPPED).alias("gone"))
    return snapshots.guarded_drop(rows, F.col("gone")).select("id", "brand", "validated")


@query(
    """WITH u AS (SELECT p_partkey AS id, ['h' || (p_partkey % 3), 'a', 'h' || (p_partkey % 4), 'b', 'c', 'd', 'e'] AS l, [CASE WHEN p_partkey % 2 = 0 THEN 'b' END, CASE WHEN p_partkey % 3 = 0 THEN 'h1' END, CASE WHEN p_partkey % 5 = 0 THEN 'h2' END] AS good FROM part),
f AS (SELECT id, l, list_filter(l, lambda x: list_contains(good, x))[1] AS hero FROM u)
SELECT id, hero, array_to_string(([hero] || list_filter(l[2:], lambda x: x <> hero))[1:5], ' ') AS images FROM f WHERE hero IS NOT NULL"""
)
def image_repair(spark: SparkSession, folder: str) -> DataFrame:
    """B13 J14."""
    key = F.col("p_partkey")
    url = lambda n: F.concat(F.lit("h"), (key % n).cast("string"))
    good = F.array(F.when(key % 2 == 0, "b"), F.when(key % 3 == 0, "h1"), F.when(key % 5 == 0, "h2"))
    made = snapshots.repaired_images(url(3), F.array(F.lit("a"), url(4), *map(F.lit, "bcde")), F.filter(good, lambda u: u.isNotNull()))
    return table(spark, folder, "part").select(key.alias("id"), made.alias("m")).where("m IS NOT NULL").select("id", "m.hero", F.array_join("m.images", " ").alias("images"))


@query("SELECT o_orderkey, o_orderkey % 7 > 0 AND coalesce(status IN (200, 206), false) AND starts_with(lower(kind), 'image/') AND NOT regexp_matches(lower(kind), '^image/hei[cf]') AS ok FROM (SELECT o_orderkey, [200, 404, 206][1 + o_orderkey % 3] AS status, ['Image/png', 'image/HEIC', 'text/html', 'image/heif-x', 'image/webp'][1 + o_orderkey % 5] AS kind FROM orders)")
def image_check(spark: SparkSession, folder: str) -> DataFrame:
    """P14, on results of requests."""
    pick = lambda xs: F.get(F.array(*map(F.lit, xs)), (F.col("o_orderkey") % len(xs)).cast("int"))
    return table(spark, folder, "orders").select("o_orderkey", snapshots.image_loads(F.when(F.col("o_orderkey") % 7 > 0, "https://i/x").otherwise("data:x"), pick([200, 404, 206]), pick(["Image/png", "image/HEIC", "text/html", "image/heif-x", "image/webp"])).alias("ok"))


def _colored(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(text.infer_category(F.col("p_type"), F.col("p_name")).alias("category"), text.infer_colors(F.col("p_name"), F.lit("")).alias("color_tags"))


@query(f"SELECT n, n_neutral, n_neutral / greatest(n, 1) AS part FROM (SELECT count(*) AS n, count(*) FILTER (len(c) = 0 OR c = ['neutral']) AS n_neutral FROM (SELECT {sql_colors('lower(p_name)')} AS c FROM part))")
def content_stats(spark: SparkSession, folder: str) -> DataFrame:
    """A5."""
    return snapshots.content_stats(_colored(spark, folder))


@query(f"SELECT {sql_category("lower(p_type || ' ' || p_name)")} AS category, count(*) AS n FROM part GROUP BY 1")
def category_mix(spark: SparkSession, folder: str) -> DataFrame:
    """A6."""
    return snapshots.category_mix(_colored(spark, folder))


# Links and hosts.

_TEMPLATE = "https://go.example/deep?mid=7&ued={url}"
_SQL_QUOTED = "url_encode(target)"
_SQL_LINKS = f"""(SELECT page_id, url AS target, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN '{links.REDIRECT}?key=k1&u=' || url_encode(url) || '&cuid=c' WHEN 2 THEN 'https://go.example/deep?mid=7&ued=' || url_encode(url) ELSE url || '?a=b c&d=é*~' END AS u FROM pages)"""


def _links(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    redirect = F.concat(F.lit(links.REDIRECT + "?key=k1&u="), links.quote(url), F.lit("&cuid=c"))
    made = F.when(F.col("page_id") % 4 == 0, url).when(F.col("page_id") % 4 == 1, redirect).when(F.col("page_id") % 4 == 2, F.concat(F.lit("https://go.example/deep?mid=7&ued="), links.quote(url))).otherwise(F.concat(url, F.lit("?a=b c&d=é*~")))
    return table(spark, folder, "pages").select("page_id", made.alias("u"))


@query(
    f"""SELECT page_id,
  CASE WHEN starts_with(u, 'https://go.example/deep?mid=7&ued=') THEN u ELSE 'https://go.example/deep?mid=7&ued=' || url_encode(CASE WHEN page_id % 4 = 1 THEN target ELSE u END) END AS by_template,
  CASE WHEN starts_with(u, '{links.REDIRECT}') THEN u ELSE '{links.REDIRECT}?key=k%261&u=' || replace(url_encode(u), '%20', '+') || '&cuid=c+d' END AS by_redirect, u AS by_none FROM {_SQL_LINKS}"""
)
def affiliate_wrap(spark: SparkSession, folder: str) -> DataFrame:
    """By template, by redirect, and without either."""
    u, no = F.col("u"), F.lit(None).cast("string")
    wrap = lambda template, key: links.wrap(u, template, F.lit(key), F.lit("c d"))
    return _links(spark, folder).select("page_id", wrap(F.lit(_TEMPLATE), "k&1").alias("by_template"), wrap(no, "k&1").alias("by_redirect"), wrap(no, "").alias("by_none"))


@query(f"SELECT page_id, CASE WHEN page_id % 4 = 1 THEN target ELSE u END AS url FROM {_SQL_LINKS}")
def affiliate_unwrap(spark: SparkSession, folder: str) -> DataFrame:
    """F20."""
    return _links(spark, folder).select("page_id", links.unwrap(F.col("u")).alias("url"))


_SQL_HOST = "regexp_replace(regexp_extract(regexp_extract(lower(url), 'https?://([^/\\s]+)', 1), '^[^/?#]*'), '^www\\.', '')"


@query(f"SELECT page_id, h AS host, regexp_replace(split_part(h, '.', 1), '[^a-z0-9]', '', 'g') AS label FROM (SELECT page_id, {_SQL_HOST} AS h FROM pages)")
def extract_host(spark: SparkSession, folder: str) -> DataFrame:
    """F22 F23."""
    host = text.extract_host(F.concat(F.lit("see "), "url"))
    return table(spark, folder, "pages").select("page_id", host.alias("host"), text.registrable_label(host).alias("label"))


# Requests.

_ASKED = ["{}", "shop ASOS", "H&M {}", "  ", "https://www.shop{}.com/x", "LA {} London", "beth miller"]


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as requests for brands."""
    asked = F.lit(None).cast("string")
    for k, t in enumerate(_ASKED):
        parts = [F.lit(p) for p in t.split("{}")]
        one = F.concat(parts[0], F.regexp_replace("s_name", "[^A-Za-z0-9]", ""), parts[1]) if len(parts) == 2 else parts[0]
        asked = F.when(F.col("s_suppkey") % len(_ASKED) == k, one).otherwise(asked)
    return table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), asked.alias("brand_text"), F.col("s_nationkey").alias("user_id"))


_SQL_REQUESTS = "(SELECT s_suppkey AS id, s_nationkey AS user_id, CASE s_suppkey % 7 " + " ".join("WHEN {} THEN {}".format(k, " || regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g') || ".join(f"'{p}'" for p in t.split("{}"))) for k, t in enumerate(_ASKED)) + " END AS brand_text FROM supplier)"
_SQL_CANDIDATES = f"""(SELECT id, brand_text, user_id, CASE WHEN host IS NOT NULL THEN [host] WHEN n = '' THEN [] ELSE list_filter(c, lambda x, i: x IS NOT NULL AND list_position(c, x) = i)[1:6] END AS domains, host, n FROM (
  SELECT *, [j || '.com', replace(n, ' ', '-') || '.com', 'the' || j || '.com', j || '.co', CASE WHEN regexp_matches(lower(brand_text), 'uk|london|britain|\\.co\\.uk') THEN j || '.co.uk' END,
    CASE WHEN regexp_matches(lower(brand_text), 'australia|\\.au|au\\)| au') THEN j || '.com.au' END, j || 'studio.com'] AS c
  FROM (SELECT *, {sql_norm("brand_text")} AS n, replace({sql_norm("brand_text")}, ' ', '') AS j, nullif(regexp_replace(regexp_extract(lower(brand_text), 'https?://([^/\\s]+)', 1), '^www\\.', ''), '') AS host FROM {_SQL_REQUESTS})))"""


@query(f"SELECT id, place - 1 AS place, domains[place] AS domain FROM (SELECT id, domains, unnest(range(1, len(domains) + 1)) AS place FROM {_SQL_CANDIDATES})")
def candidate_domains(spark: SparkSession, folder: str) -> DataFrame:
    """F24."""
    return requests.candidates(_requests(spark, folder)).select("id", F.col("place").cast("long").alias("place"), "domain")


def _probes(spark: SparkSession, folder: str) -> DataFrame:
    """Some domains as stores that answer."""
    found = requests.candidates(_requests(spark, folder)).select("domain").distinct()
    size = F.length("domain")
    return found.where(size % 3 != 0).select("domain", (size % 11).cast("int").alias("n_products"), F.get(F.array(F.lit("eur "), F.lit(""), F.lit("JPY"), F.lit("USD")), size % 4).alias("currency"))


def _stores(spark: SparkSession, folder: str) -> DataFrame:
    """Every thirteenth supplier as a store that is there already."""
    name = F.regexp_replace("s_name", "[^A-Za-z0-9]", "")
    return table(spark, folder, "supplier").where("s_suppkey % 13 = 0").select(F.col("s_suppkey").alias("store_order"), name.alias("brand"), F.concat(F.lit("www.shop"), F.lower(name), F.lit(".co")).alias("domain"))


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    asked = requests.resolved(_requests(spark, folder), _probes(spark, folder))
    return requests.judged(asked, _stores(spark, folder), F.array(*map(F.lit, rules.FX_TO_USD)))


_SQL_JUDGED = f"""
WITH c AS (SELECT id, brand_text, user_id, n, host, place, domains[place] AS domain FROM (SELECT *, unnest(range(1, len(domains) + 1)) AS place FROM {_SQL_CANDIDATES})),
p AS (SELECT DISTINCT domain, len(domain) % 11 AS n_products, ['eur ', '', 'JPY', 'USD'][1 + len(domain) % 4] AS currency FROM c WHERE len(domain) % 3 <> 0 AND len(domain) % 11 > 0),
hit AS (SELECT id, arg_min({{'domain': p.domain, 'n': n_products, 'cur': currency}}, place) AS s FROM c JOIN p USING (domain) GROUP BY id),
stores AS (SELECT regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g') AS brand, 'www.shop' || lower(regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g')) || '.co' AS domain FROM supplier WHERE s_suppkey % 13 = 0),
q AS (SELECT r.id, r.user_id, trim(r.brand_text) AS asked, {sql_norm("r.brand_text")} AS n, hit.s.domain AS domain, hit.s.n AS n_products, upper(trim(hit.s.cur)) AS cur,
  regexp_replace(split_part(regexp_replace(lower(hit.s.domain), '^www\\.', ''), '.', 1), '[^a-z0-9]', '', 'g') AS label FROM {_SQL_REQUESTS} r LEFT JOIN hit USING (id)),
judged AS (SELECT *, CASE WHEN asked = '' THEN 'empty request' WHEN domain IS NULL THEN 'no store found for this brand'
  WHEN domain IN (SELECT domain FROM stores) OR label IN (SELECT regexp_replace(split_part(regexp_replace(domain, '^www\\.', ''), '.', 1), '[^a-z0-9]', '', 'g') FROM stores) OR replace(n, ' ', '') IN (SELECT lower(brand) FROM stores) THEN 'already listed'
  WHEN list_contains({sql_list(rules.DENIED_NAMES)}, label) OR list_contains({sql_list(rules.DENIED_NAMES)}, replace(n, ' ', '')) OR list_has_any({sql_list(rules.DENIED_NAMES)}, string_split(n, ' ')) OR {sql_parts("n", rules.DENIED_PHRASES)} THEN 'not a niche brand'
  WHEN n_products < 5 THEN 'store too small' WHEN cur <> '' AND NOT list_contains({sql_list(list(rules.FX_TO_USD))}, cur) THEN 'unsupported currency ' || cur END AS reject_reason FROM q)"""


@query(_SQL_JUDGED + " SELECT id, domain, coalesce(nullif(cur, ''), 'USD') AS currency, reject_reason FROM judged")
def request_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """P5 P6 P7 F27 J11 S15 S16 D7."""
    return _judged(spark, folder).select("id", "domain", "currency", "reject_reason")


@query(_SQL_JUDGED + " SELECT id, CASE WHEN reject_reason IS NULL THEN 'awaiting_review' ELSE 'rejected' END AS status, CASE WHEN reject_reason IS NULL THEN domain || ' ' || coalesce(nullif(cur, ''), 'USD') || ' ' || len(domain) || ' i' END AS sample FROM judged")
def review_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Requests that await review, with products of their store."""
    product = F.struct(F.col("domain").alias("title"), F.array(F.struct(F.char_length("domain").cast("string").alias("price"))).alias("variants"), F.array(F.struct(F.lit("i").alias("src"))).alias("images"))
    offers = _probes(spark, folder).select("domain", F.array(product).alias("products"))
    updates = requests.review_updates(requests.with_samples(_judged(spark, folder), offers), as_of())
    return updates.select("id", "status", F.array_join(F.transform("sample", lambda p: F.concat_ws(" ", p["name"], p["price"], p["image"])), ";").alias("sample"))


@query(_SQL_JUDGED + " SELECT CASE WHEN reject_reason IS NULL THEN 'awaiting_review' ELSE 'rejected' END AS status, reject_reason, count(*) AS n FROM judged GROUP BY ALL")
def review_counts(spark: SparkSession, folder: str) -> DataFrame:
    """B9 M1 M5 A10."""
    return requests.review_updates(_judged(spark, folder), as_of()).groupBy("status", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""SELECT id, CASE WHEN id % 7 = 4 THEN upper(label[1]) || label[2:] ELSE array_to_string(list_transform(list_filter(string_split(brand_text, ' '), lambda w: w <> ''), lambda w: CASE WHEN upper(w) = w AND lower(w) <> w THEN w ELSE upper(w[1]) || lower(w[2:]) END), ' ') END AS name
FROM (SELECT *, 'x' AS label_ , array_to_string(list_transform(regexp_extract_all(regexp_replace(split_part(regexp_replace(regexp_extract(lower(brand_text), 'https?://([^/\\s]+)', 1), '^www\\.', ''), '.', 1), '[^a-z0-9]', '', 'g'), '[a-z]+|[0-9]+'), lambda w: upper(w[1]) || w[2:]), ' ') AS label FROM {_SQL_REQUESTS})"""
)
def display_name(spark: SparkSession, folder: str) -> DataFrame:
    """F25."""
    return _requests(spark, folder).select("id", text.display_name(F.col("brand_text"), text.extract_host(F.col("brand_text"))).alias("name"))


def _states(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as requests in all their states."""
    key = F.col("o_orderkey")
    pick = lambda xs: F.get(F.array(*[F.lit(x) for x in xs]), (key % len(xs)).cast("int"))
    return table(spark, folder, "orders").select(
        key.alias("id"), F.col("o_custkey").alias("user_id"), pick(["pending", "awaiting_review", "approved", "added", "rejected"]).alias("status"),
        F.when(key % 17 != 0, F.concat(F.lit("Brand "), (key % 301).cast("string"))).alias("resolved_brand"),
        F.when(key % 19 != 0, F.concat(F.lit("B"), (key % 301).cast("string"), F.lit(".com"))).alias("resolved_domain"),
        F.when(key % 3 != 0, "EUR").alias("candidate_currency"),
        F.when(key % 4 > 0, F.date_format(as_of() - F.make_dt_interval(days=(key % 29).cast("int")), "yyyy-MM-dd HH:mm:ss")).when(key % 8 == 0, "soon").alias("review_emailed_at"),
    )


_SQL_STATES = f"""(SELECT o_orderkey AS id, o_custkey AS user_id, ['pending', 'awaiting_review', 'approved', 'added', 'rejected'][1 + o_orderkey % 5] AS status,
  CASE WHEN o_orderkey % 17 <> 0 THEN 'Brand ' || (o_orderkey % 301) END AS brand, CASE WHEN o_orderkey % 19 <> 0 THEN 'B' || (o_orderkey % 301) || '.com' END AS domain, CASE WHEN o_orderkey % 3 <> 0 THEN 'EUR' ELSE 'USD' END AS currency,
  CASE WHEN o_orderkey % 4 > 0 THEN TIMESTAMP '{AS_OF}' - to_days((o_orderkey % 29)::INT) END AS emailed, o_orderkey % 4 = 0 AND o_orderkey % 8 = 0 AS garbled FROM orders)"""


@query(f"SELECT id, CASE WHEN emailed IS NULL THEN 'never emailed' ELSE 'link expired' END AS reason FROM {_SQL_STATES} WHERE status = 'awaiting_review' AND brand IS NOT NULL AND domain IS NOT NULL AND NOT garbled AND (emailed IS NULL OR emailed + INTERVAL 14 DAY <= TIMESTAMP '{AS_OF}')")
def resend_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """B11 P12 M3."""
    return requests.to_resend(_states(spark, folder), as_of()).select("id", "reason")


@query(f"""SELECT id, 'n' || id AS approval_nonce, CASE WHEN id % 3 > 0 THEN '{AS_OF}' END AS emailed FROM {_SQL_STATES} WHERE status = 'awaiting_review' AND brand IS NOT NULL AND domain IS NOT NULL AND NOT garbled AND (emailed IS NULL OR emailed + INTERVAL 14 DAY <= TIMESTAMP '{AS_OF}')""")
def resend_updates(spark: SparkSession, folder: str) -> DataFrame:
    """M2 M3: new nonces before the mail, stamps after it, for those mails that went out."""
    state = _states(spark, folder)
    nonces = state.select("id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("nonce"))
    minted = requests.reminted_updates(state, nonces, as_of()).drop("reason")
    stamped = requests.emailed_updates(minted.where("id % 3 > 0"), F.lit(AS_OF))
    return minted.join(stamped, "id", "left").withColumnRenamed("review_emailed_at", "emailed")


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(F.col("s_suppkey").cast("int").alias("store_order"), F.col("s_name").alias("brand"), F.concat(F.lit("b"), (F.col("s_suppkey") * 2).cast("string"), F.lit(".COM")).alias("domain"))


@query(
    f"""SELECT brand, domain, currency, user_id, id AS request_id, status = 'added' AS healed FROM (SELECT *, row_number() OVER (PARTITION BY lower(domain) ORDER BY status = 'added', id) AS n FROM {_SQL_STATES}
  WHERE status IN ('approved', 'added') AND brand IS NOT NULL AND domain IS NOT NULL AND lower(domain) NOT IN (SELECT 'b' || (s_suppkey * 2) || '.com' FROM supplier)) WHERE n = 1"""
)
def added_stores(spark: SparkSession, folder: str) -> DataFrame:
    """B10 J12 J13 U3 D3."""
    return requests.added_stores(_states(spark, folder), _listed(spark, folder))


@query(f"SELECT CASE WHEN status = 'approved' THEN 'added' ELSE status END AS status, count(*) AS n FROM {_SQL_STATES} GROUP BY 1")
def state_after(spark: SparkSession, folder: str) -> DataFrame:
    """M4 K3: the snapshot with its updates, counted by state."""
    state = _states(spark, folder).withColumn("added_at", F.lit(None).cast("timestamp_ntz"))
    return requests.apply_updates(state, requests.added_updates(state, as_of())).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# Announcements.

_FOLLOWED = "SELECT DISTINCT p_brand AS brand FROM part"


def _new_brands(spark: SparkSession, folder: str) -> DataFrame:
    first = table(spark, folder, "part").groupBy("p_brand").agg(F.min("p_partkey").alias("request_id"))
    return first.select(F.col("p_brand").alias("brand"), (F.col("request_id") % 97 + 1).alias("user_id"), "request_id")


def _follows(spark: SparkSession, folder: str) -> DataFrame:
    brands = table(spark, folder, "lineitem").join(table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand")), "l_partkey")
    return brands.join(table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id")), "l_orderkey").select("brand", "user_id").distinct()


def _profiles(spark: SparkSession, folder: str) -> DataFrame:
    token = F.concat(F.get(F.array(F.lit("ExponentPushToken["), F.lit(" ExpoPushToken["), F.lit("fcm:")), (F.col("c_custkey") % 3).cast("int")), "c_custkey", F.lit("]"))
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 10 != 0, token).alias("push_token"))


_SQL_RECIPIENTS = """
WITH nb AS (SELECT p_brand AS brand, min(p_partkey) % 97 + 1 AS user_id FROM part GROUP BY 1),
f AS (SELECT DISTINCT p_brand AS brand, o_custkey AS user_id FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
r AS (SELECT brand, user_id, bool_or(q) AS is_requester FROM (SELECT brand, user_id, true AS q FROM nb UNION ALL SELECT brand, user_id, false FROM f WHERE brand IN (SELECT brand FROM nb)) GROUP BY ALL)"""


@query(_SQL_RECIPIENTS + " SELECT * FROM r")
def announce_recipients(spark: SparkSession, folder: str) -> DataFrame:
    """U2 J10 D4."""
    return announce.recipients(_new_brands(spark, folder), _follows(spark, folder))


@query(
    _SQL_RECIPIENTS
    + """, p AS (SELECT c_custkey AS id, trim(['ExponentPushToken[', ' ExpoPushToken[', 'fcm:'][1 + c_custkey % 3] || c_custkey || ']') AS "to" FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 3 < 2)
SELECT brand, user_id, "to", CASE WHEN is_requester THEN '✦ ' || brand || ' is now on the feed — the brand you asked for just landed.' ELSE '✦ New on the feed: ' || brand || ' — a brand you follow just dropped.' END AS body FROM r JOIN p ON p.id = user_id"""
)
def announce_messages(spark: SparkSession, folder: str) -> DataFrame:
    """B8 J9 P13 F32."""
    people = announce.recipients(_new_brands(spark, folder), _follows(spark, folder))
    return announce.messages(people, _profiles(spark, folder))


# Vectors and counts.

_SQL_PAIRS = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), q AS (SELECT vec_id AS query_id, e AS f FROM v ORDER BY vec_id LIMIT 300),
p AS (SELECT query_id, vec_id, list_cosine_similarity(f, e) AS c FROM q JOIN v ON query_id <> vec_id)"""


@query(_SQL_PAIRS + " SELECT query_id, arg_min(vec_id, (-round(c, 9), vec_id)) AS neighbour_id, round(max(c), 6) AS cosine FROM p GROUP BY query_id")
def knn_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """B12 J15 A12."""
    return neighbours.nearest(table(spark, folder, "embeddings"), 300, "vec_id", "embedding").withColumn("cosine", F.round("cosine", 6))


@query(_SQL_PAIRS.replace("ORDER BY vec_id LIMIT 300", "WHERE vec_id % 50 = 0") + ", r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(c, 9) DESC, vec_id)::INT AS rank FROM p) SELECT query_id, vec_id AS neighbour_id, round(c, 6) AS cosine, rank FROM r WHERE rank <= 5")
def knn_cosine(spark: SparkSession, folder: str) -> DataFrame:
    """More like each item whose id is divisible by 50, among all items."""
    items = table(spark, folder, "embeddings")
    return neighbours.k_nearest(items, items.where("vec_id % 50 = 0"), 5, "vec_id", "embedding").withColumn("cosine", F.round("cosine", 6))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS length, array_to_string(list_transform(embedding, lambda x: greatest(-127, least(127, round_even((x * 127::FLOAT)::DOUBLE, 0)))::INT), ',') AS bytes FROM embeddings")
def quantize_int8(spark: SparkSession, folder: str) -> DataFrame:
    """F37 F38."""
    e = F.col("embedding")
    return table(spark, folder, "embeddings").select("vec_id", F.round(vectors.norm(e), 6).alias("length"), F.array_join(vectors.quantize(e).cast("array<string>"), ",").alias("bytes"))


@query("SELECT vec_id, to_base64(unhex(array_to_string(list_transform(embedding, lambda x: printf('%02x', (greatest(-127, least(127, round_even((x * 127::FLOAT)::DOUBLE, 0)))::INT + 256) % 256)), ''))) AS payload FROM embeddings")
def embedding_payload(spark: SparkSession, folder: str) -> DataFrame:
    """K7."""
    return table(spark, folder, "embeddings").select("vec_id", vector_payload(vectors.quantize(F.col("embedding"))).alias("payload"))


@query("SELECT p_brand, p_name, count(*) AS n_events, count(DISTINCT o_custkey) AS n_people FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING' GROUP BY ALL HAVING count(DISTINCT o_custkey) >= 50")
def k_anon_insights(spark: SparkSession, folder: str) -> DataFrame:
    """One segment of people is left out, as minors would be."""
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name")
    people = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    bought = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey").join(table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    return insights.suppressed_counts(bought.join(part, "l_partkey").join(people, "o_custkey"), ["p_brand", "p_name"], "o_custkey", 50, F.col("c_mktsegment") != "BUILDING")


@query("SELECT doc_id, sha1(text) AS sha1, strlen(text) AS bytes FROM documents")
def artifact_meta(spark: SparkSession, folder: str) -> DataFrame:
    """K2 F36, on texts; ``sources.tables.artifact_stamps`` does it on files."""
    return table(spark, folder, "documents").select("doc_id", F.sha1("text").alias("sha1"), F.octet_length("text").cast("long").alias("bytes"))


# The catalog, from parts as products and nations as stores.


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    variant = F.struct(F.col("p_retailprice").cast("string").alias("price"), F.lit(True).alias("available"), F.lit("M").alias("option1"), F.lit(None).cast("string").alias("option2"), F.lit(None).cast("string").alias("option3"))
    options = F.array(F.struct(F.lit("Size").alias("name"), F.lit(1).alias("position"), F.array(F.lit("S"), F.lit("M")).alias("values")))
    return table(spark, folder, "part").select(
        (key % 25).cast("int").alias("store_order"), key.alias("pos"), key.alias("id"), _variant_name().alias("title"), key.cast("string").alias("handle"),
        F.when(key % 3 > 0, F.col("p_brand")).otherwise("frontpage").alias("vendor"), F.col("p_type").alias("product_type"), F.lit(None).cast("array<string>").alias("tags"),
        F.when(key % 13 > 0, F.array(F.struct(F.concat(F.lit("http://i/"), key.cast("string")).alias("src")))).alias("images"), options.alias("options"), F.array(variant).alias("variants"),
    )


def _shops(spark: SparkSession, folder: str) -> DataFrame:
    name = F.when(F.col("n_nationkey") == 3, "Totême").when(F.col("n_nationkey") == 4, "Taottao").otherwise(F.col("n_name"))
    return table(spark, folder, "nation").select(F.col("n_nationkey").alias("store_order"), name.alias("brand"), F.concat(F.lit("shop"), F.col("n_nationkey").cast("string"), F.lit(".com")).alias("domain"), _currency("n_nationkey").alias("currency"), (F.col("n_nationkey") % 5 == 0).alias("multi_brand"))


_FEED = "(SELECT p_partkey AS pos, p_partkey % 25 AS store_order, part.* FROM part)"
_SQL_NORMALIZED = f"""
WITH feed AS {_FEED},
r AS (SELECT pos, p_partkey AS h, {_SQL_VARIANT} AS name, p_type AS kind, p_retailprice AS raw, n_nationkey AS store, CASE n_nationkey WHEN 3 THEN 'Totême' WHEN 4 THEN 'Taottao' ELSE n_name END AS store_brand, CASE WHEN p_partkey % 3 > 0 THEN p_brand END AS vendor,
    coalesce(fx, 1.0) AS fx FROM feed JOIN nation ON n_nationkey = store_order LEFT JOIN {_SQL_FX} ON f.currency = {sql_list(_CURRENCIES)}[1 + n_nationkey % {len(_CURRENCIES)}] WHERE p_partkey % 13 > 0),
b AS (SELECT *, CASE WHEN store % 5 = 0 THEN coalesce(vendor, store_brand) ELSE store_brand END AS brand, round_even(raw * fx, 0)::INT AS price FROM r),
n AS (SELECT pos, h, store, store_brand, brand, name, price, {sql_slug("brand")} || '-' || h AS id, {sql_category("lower(kind || ' ' || name)")} AS category,
    {sql_colors("lower(name || ' ' || kind)")} AS c FROM b WHERE price > 0 AND {sql_brand_key("brand")} <> 'taottao' AND NOT {sql_junk("name", "price", "kind")})"""


@query(_SQL_NORMALIZED + " SELECT id, brand, name, price, category, CASE WHEN len(c) = 0 THEN 'neutral' ELSE array_to_string(c, ',') END AS colors, 'M' AS sizes FROM n")
def normalize_product(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog rows of raw products."""
    from ..operators import catalog

    rows = catalog.normalized(catalog.with_store(_raw(spark, folder), _shops(spark, folder), _rates(spark)))
    return rows.select("id", "brand", "name", "price", "category", F.array_join("color_tags", ",").alias("colors"), F.array_join("sizes", ",").alias("sizes"))


@query(
    _SQL_NORMALIZED
    + f""", s AS (SELECT *, row_number() OVER (PARTITION BY store, {sql_base("name")} ORDER BY pos) AS v FROM n),
k AS (SELECT *, row_number() OVER (PARTITION BY store ORDER BY pos) AS w FROM s WHERE v <= 2),
i AS (SELECT *, row_number() OVER (PARTITION BY store ORDER BY md5('{SEED}' || id), id)::INT AS round FROM k WHERE w <= CASE WHEN store = 3 THEN 15 ELSE 40 END),
t AS (SELECT *, md5('{SEED}|' || store || '|' || round) AS turn FROM i),
d AS (SELECT *, row_number() OVER (PARTITION BY lower(trim(brand)), lower(trim(name)) ORDER BY round, turn, pos, id) AS x FROM t)
SELECT id, brand, name, price, round, turn, '{links.REDIRECT}?key=k&u=' || url_encode('https://shop' || store || '.com/products/' || pos) || '&cuid=app' AS affiliate_url, '2024-01-20T12:00:00Z' AS added_at FROM d WHERE x = 1"""
)
def catalog_build(spark: SparkSession, folder: str) -> DataFrame:
    """B2 U1 J2 W5 and all before: the catalog of a day without a day before."""
    from ..operators import catalog
    from ..sources.tables import CATALOG

    none = spark.createDataFrame([], CATALOG)
    templates = spark.createDataFrame([], "brand_key string, template string")
    made = catalog.build(_raw(spark, folder), _shops(spark, folder), _rates(spark), templates, none, none, F.lit(AS_OF).cast("timestamp"), SEED, 40, "k", "app")
    return made.select("id", "brand", "name", "price", "round", "turn", "affiliate_url", times.iso(F.col("added_at")).alias("added_at"))


# A day after another: two stores list some things of one maker, there is a catalog of the day before, rows by
# hand, affiliate programs, and images that were checked.

_COPIES = 1_000_000


def _day_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as products; those of store 0 are in store 20 too. Every other product has a second image."""
    key = F.col("id").cast("string")
    image = lambda host: F.struct(F.concat(F.lit(f"http://{host}/"), key).alias("src"))
    raw = _raw(spark, folder).withColumn("images", F.when(F.col("id") % 13 > 0, F.when(F.col("id") % 2 == 0, F.array(image("i"), image("j"))).otherwise(F.array(image("i")))))
    return raw.unionByName(raw.where("store_order = 0").withColumns({"store_order": F.lit(20), "pos": F.col("pos") + _COPIES}))


def _day_before(spark: SparkSession, folder: str, today: DataFrame) -> DataFrame:
    """Every fourth product of today, and brands that are gone today."""
    part, key = table(spark, folder, "part"), F.col("p_partkey")
    stamps = lambda k: {"last_seen_at": F.when(k % 5 > 0, as_of() - F.make_dt_interval(days=(k % 12).cast("int"))).cast("timestamp"), "added_at": F.when(k % 3 > 0, as_of() - F.make_dt_interval(days=(k % 40).cast("int"))).cast("timestamp")}
    known = today.where("pos % 4 = 1").withColumn("affiliate_url", F.lit("known")).withColumns(stamps(F.col("pos")))
    gone = part.where("p_partkey % 6 = 0").select(
        F.concat(F.lit("old-"), key.cast("string")).alias("id"), F.concat(F.lit("Gone "), (key % 7).cast("string")).alias("brand"), F.when(key % 5 == 0, "Gift Card").otherwise(F.col("p_name")).alias("name"),
        F.col("p_retailprice").cast("int").alias("price"), F.lit("tops").alias("category"), F.concat(F.lit("http://i/"), key.cast("string")).alias("image_url"), F.lit("old").alias("affiliate_url"), key.alias("pos"),
    ).withColumns(stamps(F.col("pos")))
    columns = ["id", "brand", "name", "price", "category", "color_tags", "image_url", "sizes", "images", "affiliate_url", "last_seen_at", "added_at"]
    return known.unionByName(gone, allowMissingColumns=True).select(*columns)


def _by_hand(spark: SparkSession, folder: str, today: DataFrame) -> DataFrame:
    """Suppliers' things, half of them of a brand that has a store, and some ids that today's stores may have too."""
    key = F.col("s_suppkey")
    own = table(spark, folder, "supplier").select(
        F.concat(F.lit("c-"), key.cast("string")).alias("id"), F.when(key % 2 == 0, "Totême").when(key % 5 == 0, "TAOTTAO").otherwise(F.concat(F.lit("Hand "), (key % 3).cast("string"))).alias("brand"), F.col("s_name").alias("name"),
        F.lit(200).alias("price"), F.lit("tops").alias("category"), F.concat(F.when(key % 9 == 0, "http://i/").otherwise("http://j/"), key.cast("string")).alias("image_url"), F.concat(F.lit("https://hand/"), key.cast("string")).alias("affiliate_url"),
    )
    return own.unionByName(today.where("pos % 50 = 7").withColumn("affiliate_url", F.lit("https://hand/too")).drop("store_order", "store_brand", "domain", "handle", "pos"), allowMissingColumns=True)


def _checks(spark: SparkSession, folder: str) -> DataFrame:
    """Images of host i: every eleventh is lost, and all of store 7's and of those gone brands whose number is 3. Host j has all."""
    key = F.col("p_partkey")
    lost = (key % 11 == 0) | (key % 25 == 7) | ((key % 6 == 0) & (key % 7 == 3))
    one = lambda host, status: table(spark, folder, "part").select(F.concat(F.lit(f"http://{host}/"), key.cast("string")).alias("url"), status.alias("status"), F.lit("image/png").alias("content_type"))
    return one("i", F.when(lost, 404).otherwise(200)).unionByName(one("j", F.lit(206)))


_PROGRAMS = {"toteme": "https://go.example/t?u={url}", "hand1": "https://hand.example/?u={url}"}
_SQL_LOADS = "(CASE WHEN starts_with(u, 'http://i/') THEN u[10:]::BIGINT <= m AND NOT (u[10:]::BIGINT % 11 = 0 OR u[10:]::BIGINT % 25 = 7 OR (u[10:]::BIGINT % 6 = 0 AND u[10:]::BIGINT % 7 = 3)) ELSE u[10:]::BIGINT <= m END)"


def _sql_stamps(k: str) -> str:
    return f"CASE WHEN {k} % 5 > 0 THEN TIMESTAMP '{AS_OF}' - to_days(({k} % 12)::INT) END AS last_seen_at, CASE WHEN {k} % 3 > 0 THEN TIMESTAMP '{AS_OF}' - to_days(({k} % 40)::INT) END AS added_at"


_SQL_WRAPPED = f"CASE WHEN brand = 'Totême' THEN 'https://go.example/t?u=' || url_encode(url) WHEN brand = 'Hand 1' THEN 'https://hand.example/?u=' || url_encode(url) ELSE '{links.REDIRECT}?key=k&u=' || url_encode(url) || '&cuid=app' END"


@query(
    _SQL_NORMALIZED.replace(_FEED, f"(SELECT p_partkey AS pos, p_partkey % 25 AS store_order, part.* FROM part UNION ALL SELECT p_partkey + {_COPIES}, 20, part.* FROM part WHERE p_partkey % 25 = 0)")
    + f""", a AS (SELECT *, row_number() OVER (PARTITION BY store, {sql_base("name")} ORDER BY pos) AS v FROM n),
k0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store ORDER BY pos) AS w FROM a WHERE v <= 2 AND store <> 20) WHERE w <= CASE WHEN store = 3 THEN 15 ELSE 40 END),
f AS (SELECT *, row_number() OVER (PARTITION BY {sql_base("name")} ORDER BY pos) AS v FROM n WHERE store = 20 AND id NOT IN (SELECT id FROM k0)),
k1 AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY pos) AS w FROM f WHERE v <= 2) WHERE w <= 40),
k AS (SELECT * FROM k0 UNION ALL SELECT * FROM k1),
today AS (SELECT *, row_number() OVER (PARTITION BY store ORDER BY md5('{SEED}' || id), id)::INT AS round FROM k),
scraped AS (SELECT 1 AS part, round, md5('{SEED}|' || store || '|' || round) AS turn, pos, id, brand, name, price, 'http://i/' || h AS image_url, CASE WHEN h % 2 = 0 THEN ['http://i/' || h, 'http://j/' || h] ELSE ['http://i/' || h] END AS images,
    'https://shop' || store || '.com/products/' || h AS url, TIMESTAMP '{AS_OF}' AS last_seen_at FROM today),
hand AS (SELECT 'c-' || s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'Totême' WHEN s_suppkey % 5 = 0 THEN 'TAOTTAO' ELSE 'Hand ' || (s_suppkey % 3) END AS brand, s_name AS name, 200 AS price, CASE WHEN s_suppkey % 9 = 0 THEN 'http://i/' ELSE 'http://j/' END || s_suppkey AS image_url, NULL::VARCHAR[] AS images, 'https://hand/' || s_suppkey AS url FROM supplier
    UNION ALL SELECT id, brand, name, price, 'http://i/' || h, CASE WHEN h % 2 = 0 THEN ['http://i/' || h, 'http://j/' || h] ELSE ['http://i/' || h] END, 'https://hand/too' FROM n WHERE pos % 50 = 7),
live AS (SELECT * FROM scraped UNION ALL SELECT 2, NULL, NULL, NULL, hand.*, TIMESTAMP '{AS_OF}' FROM hand WHERE id NOT IN (SELECT id FROM scraped)),
prev AS (SELECT id, brand, name, price, 'http://i/' || h AS image_url, CASE WHEN h % 2 = 0 THEN ['http://i/' || h, 'http://j/' || h] ELSE ['http://i/' || h] END AS images, 'known' AS link, {_sql_stamps("pos")} FROM n WHERE pos % 4 = 1
    UNION ALL SELECT 'old-' || p_partkey, 'Gone ' || (p_partkey % 7), CASE WHEN p_partkey % 5 = 0 THEN 'Gift Card' ELSE p_name END, trunc(p_retailprice)::INT, 'http://i/' || p_partkey, NULL, 'old', {_sql_stamps("p_partkey")} FROM part WHERE p_partkey % 6 = 0),
kept AS (SELECT * FROM prev WHERE brand NOT IN (SELECT trim(brand) FROM live) AND id NOT IN (SELECT id FROM live) AND coalesce(last_seen_at, added_at) >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND NOT {sql_junk("name", "price", chr(39) * 2)}),
every AS (SELECT part, round, turn, pos, id, brand, name, price, image_url, images, {_SQL_WRAPPED} AS affiliate_url, last_seen_at FROM live
    UNION ALL SELECT 3, NULL, NULL, NULL, id, brand, name, price, image_url, images, link, last_seen_at FROM kept),
good AS (SELECT every.*, list_filter(list_distinct([image_url] || coalesce(images, [])), lambda u: {_SQL_LOADS}) AS g FROM every, (SELECT max(p_partkey) AS m FROM part)),
hero AS (SELECT *, CASE WHEN list_contains(g, image_url) THEN image_url ELSE list_filter(coalesce(images, []), lambda u: list_contains(g, u))[1] END AS h FROM good),
doubt AS (SELECT brand, avg((h IS NULL)::INT) > 0.4 OR (SELECT avg((h IS NULL)::INT) FROM hero) > 0.4 AS doubt FROM hero GROUP BY brand),
fine AS (SELECT hero.* EXCLUDE (image_url, images), CASE WHEN doubt THEN image_url ELSE h END AS image_url, CASE WHEN doubt THEN images ELSE ([h] || list_filter(coalesce(images, []), lambda u: u <> h))[1:5] END AS images FROM hero JOIN doubt USING (brand) WHERE doubt OR h IS NOT NULL),
once AS (SELECT *, row_number() OVER (PARTITION BY lower(trim(brand)), lower(trim(name)) ORDER BY part, round, turn, pos, id) AS x FROM fine)
SELECT part, id, brand, name, price, round, turn, image_url, array_to_string(images, ' ') AS images, affiliate_url, strftime(once.last_seen_at, '%Y-%m-%dT%H:%M:%SZ') AS last_seen_at,
  strftime(CASE WHEN p.added_at IS NOT NULL THEN p.added_at WHEN p.id IS NOT NULL THEN TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY ELSE TIMESTAMP '{AS_OF}' END, '%Y-%m-%dT%H:%M:%SZ') AS added_at
FROM once LEFT JOIN (SELECT id, max(added_at) AS added_at FROM prev GROUP BY id) p USING (id) WHERE x = 1 AND {sql_brand_key("brand")} <> 'taottao' AND (SELECT count(*) FROM once WHERE x = 1) >= {rules.MIN_PUBLISHED}"""
)
def catalog_day(spark: SparkSession, folder: str) -> DataFrame:
    """The catalog of a day after another, read back as it was published."""
    from ..operators import catalog
    from ..sources.snapshots import read_published
    from ..sources.tables import materialize, publish_folder, write_catalog

    feed, shops, rates = _day_feed(spark, folder), _shops(spark, folder), _rates(spark)
    # Few bytes, and much work each: dealt anew, however few files they lie in; asked about once.
    feed = feed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    today = materialize(catalog.normalized(catalog.with_store(feed, shops, rates)))
    before, by_hand = _day_before(spark, folder, today), _by_hand(spark, folder, today)
    programs = spark.createDataFrame(pa.table({"brand_key": list(_PROGRAMS), "template": list(_PROGRAMS.values())}))
    made = catalog.build(feed, shops, rates, programs, by_hand, before, F.lit(AS_OF).cast("timestamp"), SEED, 40, "k", "app", _checks(spark, folder))
    made = made.select(
        "part", "id", "brand", "name", "price", "round", "turn", "image_url", F.array_join("images", " ").alias("images"), "affiliate_url",
        times.iso(F.col("last_seen_at")).alias("last_seen_at"), times.iso(F.col("added_at")).alias("added_at"),
    )
    path = publish_folder(spark)
    write_catalog(made, path)
    return read_published(spark, path, made.schema)


@query(
    "SELECT p_brand AS brand, array_to_string(list(p_name || ' EUR ' || round_even(p_retailprice, 0)::BIGINT || ' i' || p_partkey ORDER BY p_partkey)[1:3], ';') AS sample FROM part WHERE p_partkey % 3 > 0 GROUP BY p_brand"
)
def sample_products(spark: SparkSession, folder: str) -> DataFrame:
    """Three products of a store, with an image."""
    price = F.struct(F.col("p_retailprice").cast("string").alias("price"))
    image = F.struct(F.when(F.col("p_partkey") % 3 > 0, F.concat(F.lit("i"), F.col("p_partkey").cast("string"))).alias("src"))
    item = F.struct(F.col("p_partkey").alias("at"), F.col("p_name").alias("title"), F.array(price).alias("variants"), F.array(image).alias("images"))
    # The first three with an image, before a store's products come together.
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    first = table(spark, folder, "part").where("p_partkey % 3 > 0").withColumn("place", place).where("place <= 3")
    stores = first.groupBy(F.col("p_brand").alias("brand")).agg(F.array_sort(F.collect_list(item)).alias("products"))
    text_ = F.transform(products.samples(F.col("products"), F.lit("EUR")), lambda s: F.concat(s["name"], F.lit(" "), s["price"], F.lit(" "), s["image"]))
    return stores.select("brand", F.array_join(text_, ";").alias("sample"))
