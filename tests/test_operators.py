"""DataFrame operators on small tables, against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from feedloom.functions import products, rules, times
from feedloom.operators import announce, catalog, digest, insights, neighbours, requests, selection, snapshots
from feedloom.sources import tables



def now():
    return F.lit("2024-01-20 12:00:00").cast("timestamp")


def ids(df, column="id"):
    return sorted(r[column] for r in df.select(column).collect())


def greedy(rows, per_base=2):
    """(store, pos, id, base, cap): the walk that selection must equal."""
    seen, kept, n, n_base = set(), [], {}, {}
    for store, pos, item, base, cap in sorted(rows):
        if n.get(store, 0) >= cap or item in seen or n_base.get((store, base), 0) >= per_base:
            continue
        seen.add(item)
        kept.append((store, pos))
        n[store] = n.get(store, 0) + 1
        n_base[store, base] = n_base.get((store, base), 0) + 1
    return sorted(kept)


@pytest.mark.parametrize("seed, n_ids", [(1, 500), (2, 12), (3, 5), (4, 20)])
def test_selection(spark, seed, n_ids):
    rnd = random.Random(seed)
    unique = iter(rnd.sample(range(500), 60))
    rows = [(s, p, f"i{next(unique) if n_ids == 500 else rnd.randrange(n_ids)}", f"b{rnd.randrange(4)}", 5) for s in range(5) for p in range(12)]
    frame = spark.createDataFrame(rows, "store_order int, pos int, id string, base string, cap int")
    got = selection.select_products(frame)
    assert sorted((r.store_order, r.pos) for r in got.collect()) == greedy(rows)


def test_selection_takes_second_copy(spark):
    # The first store's copy lies beyond its cap, so the second store's is kept.
    rows = [(0, 0, "a", "x", 1), (0, 1, "b", "y", 1), (1, 0, "b", "y", 1)]
    frame = spark.createDataFrame(rows, "store_order int, pos int, id string, base string, cap int")
    assert sorted((r.store_order, r.id) for r in selection.select_products(frame).collect()) == [(0, "a"), (1, "b")]


def test_rounds_have_open_rows_only(spark):
    """Fewer rows in each round than in the one before; what is kept is the walk's."""
    rnd = random.Random(9)
    rows = [(s, p, f"i{rnd.randrange(60)}", f"b{rnd.randrange(6)}", 6) for s in range(8) for p in range(30)]
    frame = spark.createDataFrame(rows, "store int, pos int, item string, base string, cap int")
    sizes, kept = [len(rows)], []
    for found, left in selection.decided(frame):
        kept += [(r.store, r.pos) for r in found.collect()]
        sizes.append(left.count())
    assert sorted(kept) == greedy(rows) and len(set(kept)) == len(kept)
    assert all(a > b for a, b in zip(sizes, sizes[1:])) and sizes[-1] == 0 and len(sizes) <= 9


def test_selection_plan(spark):
    frame = spark.createDataFrame([(0, 0, "a", "x", 1)], "store_order int, pos int, id string, base string, cap int")
    plan = selection.capped(frame, "store_order", "base", F.col("cap"), ["pos"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    plan = selection.capped(frame, "store_order", "base", F.col("cap"), ["pos"], most=60)._jdf.queryExecution().executedPlan().toString()
    # Both ranks are cut before their rows are exchanged.
    assert plan.count("WindowGroupLimit") == 4 and plan.count("Exchange hashpartitioning") == 2 and plan.rstrip().split("Exchange hashpartitioning")[-1].count("WindowGroupLimit") == 1


def test_interleave(spark):
    frame = spark.createDataFrame([("a", i) for i in range(3)] + [("b", 9)], "store string, id int")
    rows = selection.interleave(frame, "store", "id", "s").orderBy("round", "turn").collect()
    assert {r.store for r in rows[:2]} == {"a", "b"} and sorted(r.round for r in rows) == [1, 1, 2, 3]


def test_times_in_any_zone(spark):
    """Stamps and days are of UTC whatever the session's zone."""
    at = F.lit("2024-01-20T23:30:00Z").cast("timestamp")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = spark.range(1).select(times.iso(at).alias("iso"), times.pushed_today(at, F.lit("2024-01-20T01:00:00Z").cast("timestamp")).alias("same"), times.pushed_today(at, F.lit("2024-01-21T00:30:00Z").cast("timestamp")).alias("next")).first()
            assert (r.iso, r.same, r.next) == ("2024-01-20T23:30:00Z", True, False), zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_prices_that_fit_no_number(spark):
    prices = spark.createDataFrame([("1e12",), ("inf",), ("NaN",), ("110.5",), ("111.5",), (None,)], "p string").select(F.col("p"), products.usd(F.col("p").try_cast("double"), F.lit(1.0)).alias("usd"))
    assert {r.p: r.usd for r in prices.collect()} == {"1e12": None, "inf": None, "NaN": None, "110.5": 110, "111.5": 112, None: None}


def test_keep_first_and_last(spark):
    frame = spark.createDataFrame([("x", 1, 2), ("x", 2, 1), (None, 3, 3)], "k string, pos int, v int")
    assert sorted(r.v for r in selection.keep_first(frame, ["k"], ["pos"]).collect()) == [2, 3]
    assert sorted(r.v for r in selection.keep_last(frame, ["k"], ["pos"]).collect()) == [1, 3]
    names = spark.createDataFrame([(1, " Foo", "A "), (2, "foo", "a"), (3, "foo", "b"), (4, None, None)], "pos int, brand string, name string")
    assert ids(selection.name_repeats_removed(names, ["pos"]), "pos") == [1, 3, 4]


def test_batches(spark):
    numbered = selection.batch_numbers(spark.range(1050).repartition(7).withColumnRenamed("id", "k"), "k", 20)
    assert {r.k: r.batch_no for r in numbered.collect()} == {k: k // 20 for k in range(1050)}
    assert selection.batch_numbers(spark.range(0), "id").count() == 0


def test_grace_and_added(spark):
    schema = "id string, brand string, name string, price double, last_seen_at string, added_at string"
    stamps = lambda df: df.withColumns({c: F.try_to_timestamp(c) for c in ("last_seen_at", "added_at")})
    current = spark.createDataFrame([("1", " here ", "x", 9.0)], "id string, brand string, name string, price double")
    previous = stamps(
        spark.createDataFrame(
            [
                ("2", "here", "gone today", 9.0, "2024-01-20 00:00:00", None),
                ("3", "away", "kept by last", 9.0, "2024-01-13 12:00:00", None),
                ("4", "away", "too old", 9.0, "2024-01-13 11:59:59", "2024-01-20 00:00:00"),
                ("5", "away", "kept by first", 9.0, None, "2024-01-19 00:00:00"),
                ("6", "away", "gift card", 9.0, "2024-01-19 00:00:00", None),
                ("7", "", "no brand", 9.0, "2024-01-19 00:00:00", None),
                (None, "away", "no id", 9.0, "2024-01-19 00:00:00", None),
                ("1", "away", "id is there", 9.0, "2024-01-19 00:00:00", None),
                ("8", "away", "no stamp", 9.0, None, "soon"),
            ],
            schema,
        )
    )
    assert ids(snapshots.carried_forward(current, previous, now())) == ["3", "5"]
    products = spark.createDataFrame([("5",), ("3",), ("new",)], "id string")
    got = {r.id: str(r.added_at) for r in snapshots.added_at(products, previous, now()).collect()}
    assert got == {"5": "2024-01-19 00:00:00", "3": "2023-12-21 12:00:00", "new": "2024-01-20 12:00:00"}


def test_guarded_drop(spark):
    rows = [("at", i, i < 2) for i in range(5)] + [("above", i + 10, i < 3) for i in range(5)] + [(None, i + 20, i < 1) for i in range(10)]
    frame = spark.createDataFrame(rows, "brand string, id int, gone boolean")
    got = snapshots.guarded_drop(frame, F.col("gone"))
    assert ids(got) == [2, 3, 4, 10, 11, 12, 13, 14, *range(21, 30)]
    assert {r.brand for r in got.where("NOT validated").collect()} == {"above"}
    lost = spark.createDataFrame([("a", 1, True), ("a", 2, None), ("b", 3, True), ("b", 4, False)], "brand string, id int, gone boolean")
    assert ids(snapshots.guarded_drop(lost, F.col("gone"))) == [1, 2, 3, 4]


def test_images_repaired(spark):
    array = lambda *xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    of = lambda hero, images, good: spark.range(1).select(snapshots.repaired_images(F.lit(hero).cast("string"), images, good).alias("m")).first()["m"]
    assert tuple(of("h", array("a", "h", "b"), array("b", "a"))) == ("a", ["a", "h", "b"])
    assert tuple(of("h", array("h", "b"), array("h"))) == ("h", ["h", "b"])
    assert of("h", array("a"), array()) is None
    ok = lambda s, k: spark.range(1).select(snapshots.image_loads(F.lit("http://i"), F.lit(s).cast("int"), F.lit(k).cast("string")).alias("m")).first()["m"]
    assert ok(200, "Image/PNG") and ok(206, "image/webp") and not ok(404, "image/png") and not ok(200, "image/heic") and not ok(None, None)
    assert not spark.range(1).select(snapshots.image_loads(F.lit("data:x"), F.lit(200), F.lit("image/png")).alias("m")).first()["m"]


def test_stats_and_gate(spark):
    frame = spark.createDataFrame([("tops", ["neutral"]), ("tops", ["red"]), ("shoes", ["neutral", "red"])], "category string, color_tags array<string>")
    assert tuple(snapshots.content_stats(frame).first()) == (3, 1, 1 / 3)
    assert {tuple(r) for r in snapshots.category_mix(frame).collect()} == {("tops", 2), ("shoes", 1)}
    assert tuple(snapshots.content_stats(frame.limit(0)).first()) == (0, 0, 0.0)
    assert not snapshots.may_publish(spark.range(19)) and snapshots.may_publish(spark.range(20))


LIVE = [("1", 90.0, ["M", "L"], "Foo ", " coat"), ("2", 71.0, ["Medium", "L"], "", "dress"), ("3", 100.0, [], "B", "hat"), ("4", 50.0, ["S"], "B", "top")]
SAVED = [
    ("u", 1, "1", 100.0, None, ["M", "L"]), ("u", 2, "1", 200.0, None, ["M"]), ("u", 3, "2", 100.0, None, ["M"]), ("u", 4, None, 100.0, "4", ["M", "XS"]),
    ("u", 5, "gone", 1e9, None, []), ("u", 6, "", 1.0, "", []), ("v", 1, "3", 100.0, None, ["M"]), ("w", 1, "4", 50.0, None, ["m", "S"]),
]


def made_alerts(spark):
    saved = spark.createDataFrame(SAVED, "user_id string, pos int, product_id string, price_at_save double, saved_id string, saved_sizes array<string>")
    return digest.alerts(saved, spark.createDataFrame(LIVE, "id string, price double, sizes array<string>, brand string, name string"))


def test_alerts(spark):
    got = [(r.user_id, r.rank, r.pid, r.pct, r.new_sizes, r.gone_sizes) for r in made_alerts(spark).orderBy("user_id", "rank").collect()]
    assert got == [("u", 1, "2", 28, ["L"], []), ("u", 2, "1", 10, [], []), ("u", 3, "4", 50, ["S"], ["M", "XS"]), ("w", 1, "4", None, [], ["m"])] or got == [
        ("u", 1, "4", 50, ["S"], ["M", "XS"]), ("u", 2, "2", 28, ["L"], []), ("u", 3, "1", 10, [], []), ("w", 1, "4", None, [], ["m"])
    ]
    assert got[0][3] >= got[1][3] >= got[2][3]


def test_summaries(spark):
    got = {r.user_id: r for r in digest.summaries(made_alerts(spark)).collect()}
    assert got["u"].signature == "1:s90;2:s71+L;4:s50+S-M|XS"
    assert got["u"].body == "B top is 50% off (now $50). +2 more on sale"
    assert got["w"].signature == "4:-m" and got["w"].title is None and got["w"].body is None


def test_digests(spark):
    users = spark.createDataFrame([("u", "t", None, None, None), ("w", "t", None, None, None)], "id string, token string, last_sig string, last_push_at timestamp, active_at timestamp")
    found = made_alerts(spark)
    assert [r.user_id for r in digest.digests(users, found, now()).collect()] == ["u"]
    again = users.withColumn("last_sig", F.lit("1:s90;2:s71+L;4:s50+S-M|XS"))
    assert digest.digests(again, found, now()).count() == 0
    for column, value in (("last_push_at", "2024-01-20 01:00:00"), ("active_at", "2024-01-19 12:00:00"), ("token", "")):
        assert digest.digests(users.withColumn(column, F.lit(value).cast(users.schema[column].dataType)), found, now()).count() == 0


def test_requests(spark):
    asked = spark.createDataFrame([(1, "Niche Co"), (2, " "), (3, "unknown"), (4, "shop asos niche.com"), (5, "small.com"), (6, "yen.com"), (7, "https://listed.com/a"), (8, "Listed Too")], "id int, brand_text string")
    probes = spark.createDataFrame([("nicheco.co", 9, ""), ("niche-co.com", 7, "eur"), ("niche.com", 9, None), ("small.com", 4, None), ("yen.com", 9, "JPY"), ("listed.com", 9, None), ("listedtoo.com", 9, None)], "domain string, n_products int, currency string")
    stores = spark.createDataFrame([("Other", "www.listed.de"), ("Listed  Too!", "x.com")], "brand string, domain string")
    judged = requests.judged(requests.resolved(asked, probes), stores, F.array(F.lit("EUR"), F.lit("USD")))
    got = {r.id: (r.domain, r.reject_reason) for r in judged.collect()}
    assert got == {
        1: ("niche-co.com", None), 2: (None, "empty request"), 3: (None, "no store found for this brand"), 4: ("niche.com", "not a niche brand"),
        5: ("small.com", "store too small"), 6: ("yen.com", "unsupported currency JPY"), 7: ("listed.com", "already listed"), 8: ("listedtoo.com", "already listed"),
    }
    new = {r.id: r for r in requests.review_updates(judged, now()).collect()}
    assert (new[1].status, new[1].resolved_brand, new[1].candidate_currency) == ("awaiting_review", "Niche Co", "EUR") and new[2].status == "rejected"
    state = asked.withColumns({"status": F.lit("pending"), "resolved_domain": F.lit(None).cast("string")})
    after = {r.id: (r.status, r.resolved_domain, r.brand_text) for r in requests.apply_updates(state, requests.review_updates(judged, now()).where("id < 3").select("id", "status", "resolved_domain")).collect()}
    assert after[1] == ("awaiting_review", "niche-co.com", "Niche Co") and after[2][0] == "rejected" and after[3] == ("pending", None, "unknown")


def test_added_stores(spark):
    rows = [(1, "approved", "A", "a.com", None), (2, "approved", "A2", "A.com ", "EUR"), (3, "added", "Lost", "lost.com", ""), (4, "added", "There", "THERE.com", None), (5, "approved", "", "x.com", None), (6, "pending", "P", "p.com", None)]
    frame = spark.createDataFrame(rows, "id int, status string, resolved_brand string, resolved_domain string, candidate_currency string").withColumn("user_id", F.col("id"))
    stores = spark.createDataFrame([("There", "there.com")], "brand string, domain string")
    got = {(r.brand, r.domain, r.currency, r.healed) for r in requests.added_stores(frame, stores).collect()}
    assert got == {("A", "a.com", "USD", False), ("Lost", "lost.com", "USD", True)}
    assert ids(requests.added_updates(frame, now())) == [1, 2, 5]


def test_resend(spark):
    rows = [(1, "awaiting_review", "B", "b.com", None), (2, "awaiting_review", "B", "b.com", "2024-01-06 12:00:00"), (3, "awaiting_review", "B", "b.com", "2024-01-07 12:00:00"), (4, "awaiting_review", "", "b.com", None), (5, "added", "B", "b.com", None), (6, "awaiting_review", "B", "b.com", "soon")]
    frame = spark.createDataFrame(rows, "id int, status string, resolved_brand string, resolved_domain string, review_emailed_at string")
    assert {r.id: r.reason for r in requests.to_resend(frame, now()).collect()} == {1: "never emailed", 2: "link expired"}


def test_samples(spark):
    product = "struct<title: string, variants: array<struct<price: string>>, images: array<struct<src: string>>>"
    values = [("A", [("",), ("2.5",)], [("i",)]), ("", [("1",)], [("i",)]), ("B", [], [("",)]), ("C", [], [(None,), ("j",)]), ("D", [("9",)], [("k",)]), ("E", [("9",)], [("k",)])]
    store = spark.createDataFrame([("x.com", values)], f"domain string, products array<{product}>")
    got = requests.with_samples(spark.createDataFrame([("x.com", "EUR")], "domain string, currency string"), store).first()["sample"]
    assert [tuple(s) for s in got] == [("A", "EUR 2", "i"), ("C", "", "j"), ("D", "EUR 9", "k")]


def test_announce(spark):
    new = spark.createDataFrame([("Foo", "u1", 1), ("Bar", None, 2), (None, "u9", 3)], "brand string, user_id string, request_id int")
    follows = spark.createDataFrame([("Foo", "u1"), ("Foo", "u2"), ("Foo", "u2"), ("foo", "u3"), ("Bar", None)], "brand string, user_id string")
    people = announce.recipients(new, follows)
    assert {tuple(r) for r in people.select("brand", "user_id", "is_requester").collect()} == {("Foo", "u1", True), ("Foo", "u2", False)}
    profiles = spark.createDataFrame([("u1", " ExpoPushToken[x]"), ("u2", "fcm"), ("u3", None)], "id string, push_token string")
    got = announce.messages(people, profiles).collect()
    assert [(r.user_id, r.to, r.body) for r in got] == [("u1", "ExpoPushToken[x]", "✦ Foo is now on the feed — the brand you asked for just landed.")]
    assert ids(announce.notified_updates(new, now())) == [1, 2]


def test_neighbours(spark, monkeypatch):
    rows = [(1, [1.0, 0.0]), (2, [0.8, 0.6]), (3, [0.0, 1.0]), (4, [0.9, 0.5]), (5, []), (6, None)]
    frame = spark.createDataFrame(rows, "id int, vec array<float>")
    assert {r.query_id: r.neighbour_id for r in neighbours.nearest(frame).collect()} == {1: 4, 2: 4, 3: 2, 4: 2}
    assert [(r.query_id, r["rank"], r.neighbour_id) for r in neighbours.k_nearest(frame, frame.where("id = 1"), 2).orderBy("query_id", "rank").collect()] == [(1, 1, 4), (1, 2, 2)]
    # Blocks of two give what one block gives.
    whole = {tuple(r) for r in neighbours.k_nearest(frame, frame, 2).select("query_id", "rank", "neighbour_id").collect()}
    monkeypatch.setattr(neighbours, "BLOCK", 2)
    assert {tuple(r) for r in neighbours.k_nearest(frame, frame, 2).select("query_id", "rank", "neighbour_id").collect()} == whole and len(whole) == 8
    assert neighbours.k_nearest(frame.limit(0), frame.limit(0)).count() == 0


def test_insights(spark):
    rows = [("a", u % 49) for u in range(200)] + [("b", u) for u in range(50)] + [("b", 1)]
    got = insights.suppressed_counts(spark.createDataFrame(rows, "k string, u int"), ["k"], "u")
    assert [tuple(r) for r in got.collect()] == [("b", 51, 50)]


def raw_rows():
    image, variant = [("http://i/1",), ("http://i/2",)], lambda p, size="M", ok=True: (p, ok, size, None, None)
    option = [("Size", 1, ["S", "M"])]
    row = lambda s, p, title, price="100", vendor="", kind="", images=image: (s, p, p, title, f"h{s}-{p}", vendor, kind, [], images, option, [variant(price)])
    return [
        row(0, 0, "Romy Loafer - Black"), row(0, 1, "Romy Loafer in Cream"), row(0, 2, "Romy Loafer (Tan)"), row(0, 3, "Gift Card"), row(0, 4, "Free", "0.00"),
        row(0, 5, "No image", images=[]), row(0, 6, "Silk Dress", "110.5"), row(1, 0, "Wool Coat", vendor="Maker"), row(1, 1, "Wool Coat", vendor="frontpage"), row(1, 2, "Hat", vendor="Tao Ttao"),
    ]


def test_catalog(spark):
    raw = spark.createDataFrame(raw_rows(), tables.RAW_PRODUCT)
    stores = spark.createDataFrame([(0, "Ganni", "ganni.com", "AUD", False), (1, "Shop", "shop.com", "XXX", True)], "store_order int, brand string, domain string, currency string, multi_brand boolean")
    fx = spark.createDataFrame(list(rules.FX_TO_USD.items()), "currency string, fx double")
    templates = tables.templates(spark, json.dumps({"GANNI ": "https://go/?u={url}", "x": "none", "y": 3}))
    empty = spark.createDataFrame([], tables.CATALOG)
    day = "2024-01-15 00:00:00"
    previous = empty.unionByName(spark.createDataFrame([("old-1", "Gone", "Old Top", 20, day, day), ("maker-h1-0", "Maker", "Wool Coat", 100, day, None)], "id string, brand string, name string, price int, last_seen_at string, added_at string").withColumns({c: F.col(c).cast("timestamp") for c in ("last_seen_at", "added_at")}), allowMissingColumns=True)
    curated = empty.unionByName(spark.createDataFrame([("c1", "Hand", "By Hand", 30, "https://hand/1"), (None, "Hand", "x", 1, None)], "id string, brand string, name string, price int, affiliate_url string"), allowMissingColumns=True)
    made = {r.id: r for r in catalog.build(raw, stores, fx, templates, curated, previous, now(), "seed", key="k").collect()}
    assert set(made) == {"ganni-h0-0", "ganni-h0-1", "ganni-h0-6", "maker-h1-0", "shop-h1-1", "c1", "old-1"}
    dress = made["ganni-h0-6"]
    assert (dress.price, dress.category, dress.color_tags, dress.sizes, dress.image_url) == (73, "dresses", ["neutral"], ["M"], "http://i/1")
    assert dress.affiliate_url == "https://go/?u=https%3A%2F%2Fganni.com%2Fproducts%2Fh0-6"
    assert made["c1"].affiliate_url.startswith("https://redirect.viglink.com/?key=k&u=https%3A%2F%2Fhand%2F1")
    assert str(made["old-1"].last_seen_at) == day and str(dress.last_seen_at) == "2024-01-20 12:00:00"
    assert str(made["maker-h1-0"].added_at) == "2023-12-21 12:00:00" and str(made["old-1"].added_at) == day
    assert made["maker-h1-0"].price == 100


def test_sources(spark, tmp_path):
    (tmp_path / "stores.json").write_text(json.dumps({"fx_to_usd": {"USD": 1.0, "EUR": 1.08}, "perBrand": 60, "brands": [{"brand": "A", "domain": "a.com", "currency": "EUR"}, {"brand": "B", "domain": "b.com", "multiBrand": True}]}, indent=1))
    stores, rates, per_brand = tables.read_stores(spark, str(tmp_path / "stores.json"))
    assert per_brand == 60 and [tuple(r) for r in stores.orderBy("store_order").collect()] == [(0, "A", "a.com", "EUR", False), (1, "B", "b.com", "USD", True)] and rates.count() == 2
    page = {"domain": "b.com", "page": 1, "products": [{"id": 1, "title": "T", "handle": "h", "variants": [{"price": "5", "available": True}]}]}
    (tmp_path / "pages.json").write_text(json.dumps(page))
    assert tuple(tables.read_landed_pages(spark, str(tmp_path / "pages.json"), stores).select("store_order", "pos", "title").first()) == (1, 250, "T")
    products = [{"id": "p", "name": "first"}, {"id": "", "name": "x"}, {"id": "p", "name": "last", "price": 3, "addedAt": "2024-01-01T00:00:00Z"}]
    for name, data in (("list", products), ("envelope", {"products": products})):
        (tmp_path / f"{name}.json").write_text(json.dumps(data))
        got = tables.read_catalog(spark, str(tmp_path / f"{name}.json")).collect()
        assert [(r.id, r.name, r.price, str(r.added_at)) for r in got] == [("p", "last", 3, "2024-01-01 00:00:00")]
    assert tables.read_or_empty(spark, str(tmp_path / "none")).count() == 0
    assert tables.templates(spark, "not json").count() == 0 and tables.templates(spark, '["a"]').count() == 0
    stamp = tables.artifact_stamps(spark, str(tmp_path / "list.json")).first()
    assert stamp.bytes == (tmp_path / "list.json").stat().st_size and len(stamp.sha1) == 40
    users = spark.createDataFrame([("a", "t", None, None, None), ("b", "", None, None, None)], "id string, push_token string, last_marketing_push_sig string, last_marketing_push_at timestamp, updated_at timestamp")
    assert ids(tables.push_users(users)) == ["a"] and tables.push_users(users.drop("updated_at")).count() == 0
    rows = tables.read_or_empty(spark, str(tmp_path / "none")).drop("added_at")
    assert not tables.write_catalog(rows, str(tmp_path / "out")) and not (tmp_path / "out").exists()
    assert tables.write_catalog(rows, str(tmp_path / "out"), 0) and (tmp_path / "out").exists()
    assert tables.read_curated(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "bad.json").write_text("no json")
    assert tables.read_curated(spark, str(tmp_path / "bad.json")).count() == 0 and tables.read_curated(spark, str(tmp_path / "list.json")).count() == 1
    tables.write_new_brands(spark.createDataFrame([("B", 1, 2), ("A", None, 3)], "brand string, user_id int, request_id int"), now(), str(tmp_path / "new"))
    handed = spark.read.json(str(tmp_path / "new")).first()
    assert handed.generatedAt == "2024-01-20T12:00:00Z" and [(b.brand, b.request_id) for b in handed.brands] == [("A", 3), ("B", 2)]
    tables.export_catalog(rows, str(tmp_path / "feed"))
    tables.write_stores(stores, spark.createDataFrame([("C", "A.com", "USD"), ("D", "d.com", "USD")], "brand string, domain string, currency string"), str(tmp_path / "cfg"))
    assert ids(spark.read.json(str(tmp_path / "cfg")), "brand") == ["A", "B", "D"]


def test_alerts_deal_rows_twice(spark):
    """Saved rows go to their product and to their user, no more often; of repeated savings the first counts."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        saved = spark.createDataFrame([(1, 2, "a", 50.0), (1, 1, "a", 100.0), (1, 3, "b", 100.0), (2, 1, "a", 80.0)], "user_id long, pos int, product_id string, price_at_save double")
        saved = saved.withColumns({"saved_id": F.lit(None).cast("string"), "saved_sizes": F.array(F.lit("S"))})
        live = spark.createDataFrame([("a", 40.0, ["S"], "x", "y"), ("b", 20.0, ["S"], "x", "z")], "id string, price double, sizes array<string>, brand string, name string")
        found = digest.alerts(saved, live)
        rows = sorted((r.user_id, r.pid, r.was, r["rank"]) for r in found.collect())
        plan = found._jdf.queryExecution().sparkPlan().toString()
        executed = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == [(1, "a", 100.0, 2), (1, "b", 100.0, 1), (2, "a", 80.0, 1)]
    # One more is that of the products.
    assert "Window" in plan and executed.count("Exchange hashpartitioning") == 3
