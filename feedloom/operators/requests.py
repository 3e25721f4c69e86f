"""Requests for brands: found, judged, added, and sent again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import products, rules, text, times
from .selection import keep_first


def candidates(requests: DataFrame, column: str = "brand_text") -> DataFrame:
    """Requests with ``place`` and ``domain``, one row for each domain to try: the host given, else likely ones."""
    asked = text.strip(text.blank(F.col(column)))
    host = text.extract_host(asked)
    tries = F.when(host.isNotNull(), F.array(host)).otherwise(text.candidate_domains(asked, text.normalize_name(asked)))
    return requests.select("*", F.posexplode(tries).alias("place", "domain"))


def resolved(requests: DataFrame, probes: DataFrame, key: str = "id") -> DataFrame:
    """Requests with the first candidate domain that has products; the probe's columns are null where none has.

    ``probes``: domain, n_products, currency, one row a store.
    """
    hit = candidates(requests.select(key, "brand_text")).join(probes.where("n_products > 0"), "domain")
    return requests.join(keep_first(hit, [key], ["place"]).drop("place", "brand_text"), key, "left")


def known_stores(requests: DataFrame, stores: DataFrame, key: str = "id") -> DataFrame:
    """Keys of requests whose domain, domain's first label, or name is a store's.

    Three equal joins, not one with OR: each is hashed.
    """
    squashed = lambda c: F.replace(text.normalize_name(c), F.lit(" "), F.lit(""))
    sides = (
        (F.lower("domain"), F.lower("domain")),
        (text.registrable_label(F.col("domain")), text.registrable_label(F.col("domain"))),
        (squashed(F.col("brand_text")), squashed(F.col("brand"))),
    )
    found = [requests.select(key, a.alias("x")).where("x <> ''").join(stores.select(b.alias("x")).where("x <> ''").distinct(), "x", "left_semi").select(key) for a, b in sides]
    return found[0].union(found[1]).union(found[2]).distinct()


def judged(requests: DataFrame, stores: DataFrame, currencies: Column, key: str = "id") -> DataFrame:
    """Resolved requests with ``reject_reason``: the first gate that holds them back, or null.

    ``currencies`` is the array of those with a rate. A store whose currency isn't known sells in dollars.
    """
    known = known_stores(requests.where("domain IS NOT NULL"), stores, key).withColumn("x_known", F.lit(True))
    asked = text.strip(text.blank(F.col("brand_text")))
    currency = F.upper(text.strip(text.blank(F.col("currency"))))
    reason = (
        F.when(asked == "", "empty request")
        .when(F.col("domain").isNull(), "no store found for this brand")
        .when(F.col("x_known"), "already listed")
        .when(text.is_denied(text.normalize_name(asked), F.col("domain")), "not a niche brand")
        .when(F.col("n_products") < rules.MIN_PRODUCTS, "store too small")
        .when((currency != "") & ~F.array_contains(currencies, currency), F.concat(F.lit("unsupported currency "), currency))
    )
    return requests.join(known, key, "left").withColumns({"reject_reason": reason, "currency": F.when(currency != "", currency).otherwise("USD")}).drop("x_known")


def review_updates(judged_: DataFrame, as_of: Column, key: str = "id") -> DataFrame:
    """The new state of each pending request: rejected with its reason, or awaiting review under a name to show.

    A ``sample`` of products (see ``with_samples``) goes with those that await review.
    """
    ok = F.col("reject_reason").isNull()
    sample = [F.when(ok, F.col("sample")).alias("sample")] if "sample" in judged_.columns else []
    return judged_.select(
        key,
        F.when(ok, "awaiting_review").otherwise("rejected").alias("status"),
        "reject_reason",
        F.when(ok, text.display_name(F.col("brand_text"), F.col("domain"))).alias("resolved_brand"),
        F.when(ok, F.col("domain")).alias("resolved_domain"),
        F.when(ok, F.col("currency")).alias("candidate_currency"),
        as_of.alias("processed_at"),
        *sample,
    )


def apply_updates(state: DataFrame, updates: DataFrame, key: str = "id") -> DataFrame:
    """The next snapshot: rows take the values of their update, where it has any."""
    changed = [c for c in updates.columns if c != key]
    new = updates.select(key, F.struct(*changed).alias("x_new"))
    columns = [F.when(F.col("x_new").isNotNull(), F.col(f"x_new.{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in state.columns]
    return state.join(new, key, "left").select(*columns)


def added_stores(requests: DataFrame, stores: DataFrame, key: str = "id") -> DataFrame:
    """Stores to append: (brand, domain, currency, user_id, request id, ``healed``), one a domain.

    Approved requests first, then added ones whose store got lost; none whose domain is there already.
    """
    rows = requests.where(F.col("status").isin("approved", "added")).select(
        text.strip(text.blank(F.col("resolved_brand"))).alias("brand"),
        text.strip(text.blank(F.col("resolved_domain"))).alias("domain"),
        F.coalesce(F.nullif(text.strip(text.blank(F.col("candidate_currency"))), F.lit("")), F.lit("USD")).alias("currency"),
        "user_id", F.col(key).alias("request_id"), (F.col("status") == "added").alias("healed"),
    )
    rows = rows.where("brand <> '' AND domain <> ''").withColumn("x_domain", F.lower("domain"))
    there = stores.select(F.lower("domain").alias("x_domain")).where("x_domain IS NOT NULL").distinct()
    return keep_first(rows.join(there, "x_domain", "left_anti"), ["x_domain"], ["healed", "request_id"]).drop("x_domain")


def added_updates(requests: DataFrame, as_of: Column, key: str = "id") -> DataFrame:
    """Every approved request is closed as added, also those that bring no store."""
    return requests.where("status = 'approved'").select(key, F.lit("added").alias("status"), as_of.alias("added_at"))


def to_resend(requests: DataFrame, as_of: Column) -> DataFrame:
    """Requests awaiting review, complete, whose mail never went out or whose link has run out; with ``reason``."""
    whole = (text.strip(text.blank(F.col("resolved_brand"))) != "") & (text.strip(text.blank(F.col("resolved_domain"))) != "")
    never = text.blank(F.col("review_emailed_at").cast("string")) == ""
    due = requests.where((F.col("status") == "awaiting_review") & whole & times.needs_resend(F.col("review_emailed_at"), as_of))
    return due.withColumn("reason", F.when(never, "never emailed").otherwise("link expired"))


def emailed_updates(sent: DataFrame, as_of: Column, key: str = "id") -> DataFrame:
    """The stamp of each request whose mail was ``sent``, and of no other: those left out are sent again."""
    return sent.select(key).distinct().withColumn("review_emailed_at", as_of)


def reminted_updates(requests: DataFrame, nonces: DataFrame, as_of: Column, key: str = "id") -> DataFrame:
    """New nonces (key, nonce) of the requests to send again, which make older links void; set before their mail goes out."""
    return to_resend(requests, as_of).select(key, "reason").join(nonces.select(key, F.col("nonce").alias("approval_nonce")), key)


def with_samples(requests: DataFrame, store_products: DataFrame) -> DataFrame:
    """Requests with up to three products of their store; ``store_products``: domain, products."""
    return requests.join(store_products, "domain", "left").withColumn("sample", products.samples(F.col("products"), F.col("currency"))).drop("products")
