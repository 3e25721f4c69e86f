"""Column functions on single values."""

import pytest
from pyspark.sql import functions as F

from feedloom.functions import links, money, products, rules, text, times, vectors


def one(spark, column, **values):
    """The value of a column over one row of typed literals."""
    row = spark.range(1).select(*[F.expr(v).alias(k) if isinstance(v, str) and v.startswith("sql:") else F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("v")).first()["v"]


def many(spark, rows, schema, column):
    """The column's value for each row."""
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r["v"] for r in frame.select("i", column.alias("v")).orderBy("i").collect()]


JUNK = [
    ("Silk Wrap Dress", 220.0, "", False),
    ("Bubble Mini Dress, Graphite", 171.0, "", False),
    ("Sun Protection Hat", 45.0, "", False),
    ("Sample Sale Tee", 30.0, "", False),
    ("Route 66 Jacket", 180.0, "", False),
    ("Dress", 1.0, "", False),
    ("Gift Card", None, "", True),
    ("E-Gift Voucher", 50.0, "", True),
    ("Returns and Exchanges", None, "", True),
    ("Size Chart", None, "", True),
    ("Shipping Protection", 2.5, "", True),
    ("Route Package Protection", 1.98, "", True),
    ("", None, "", True),
    (None, None, None, True),
    ("Nice Thing", 30.0, "gift card", True),
    ("Nice Thing", 30.0, "return,package_protection", True),
    ("Wrap Top", 14.0, "", True),
    ("Relationship Tee", 20.0, "", False),
]


def test_junk(spark):
    got = many(spark, [j[:3] for j in JUNK], "t string, p double, k string", products.is_junk(F.col("t"), F.col("p"), F.col("k")))
    assert got == [j[3] for j in JUNK]


@pytest.mark.parametrize(
    "title, want",
    [("Mohair Sweater", "tops"), ("Short Sleeve Shirt", "bottoms"), ("Cropped Jumpsuit", "dresses"), ("", "tops"), (None, "tops"), ("Earring", "accessories"), ("Two Boots", "shoes"), ("Stop", "tops"), ("Bikini Top", "tops"), ("Trench Coat Dress", "dresses")],
)
def test_category(spark, title, want):
    assert one(spark, text.infer_category(F.lit(""), F.col("t")), t=title) == want


def test_colors(spark):
    none = F.lit(None).cast("array<string>")
    options = F.array(F.struct(F.lit("Colour").alias("name"), F.lit(1).alias("position"), F.array(F.lit("Blue"), F.lit("Pink")).alias("values")))
    of = lambda t: one(spark, text.infer_colors(F.col("t"), F.lit(""), none, options), t=t)
    assert of("Red Coat") == ["red", "neutral"]  # "coat" holds "oat"
    assert of("Dress") == ["pink", "blue"]
    assert of("Black White Pink") == ["black", "white"]
    assert one(spark, text.infer_colors(F.col("t"), F.lit("")), t="Dress") == ["neutral"]
    assert one(spark, text.infer_colors(F.col("t"), F.lit(""), F.array(F.lit("navy"))), t="Dress") == ["blue"]


@pytest.mark.parametrize(
    "title, want",
    [
        ("Romy Loafer - Black", "romy loafer"), ("Romy Loafer in Cream", "romy loafer"), ("Loafer (Tan)", "loafer"), ("Loafer (2)", "loafer"),
        ("Black", "black"), ("Dress in Silk", "dress"), ("Coat - one two three", "coat one two three"), ("Coat (one (tan)", "coat one"),
        ("Top / Navy / Blue White", "top"), ("", ""), (None, ""), ("Dress - 2", "dress 2"), ("Skirt Off White Navy", "skirt off"),
    ],
)
def test_base_name(spark, title, want):
    assert one(spark, text.base_name(F.col("t").cast("string")), t=title) == want


def test_names(spark):
    assert one(spark, text.brand_key(F.col("x")), x="Totême & Söhne") == "totemeshne"
    assert text.brand_keys(["Toteme", "Totême"]) == ["toteme"]
    assert one(spark, text.slugify(F.col("x")), x="SIEDRÉS & Co!") == "siedrés---co"
    assert one(spark, text.normalize_name(F.col("x")), x="Réalisation  Pár ½ ﬁ") == "realisation par 1 2 fi"
    assert one(spark, text.normalize_type(F.col("x")), x="return,package_protection ") == "return package protection"
    assert one(spark, text.strip(F.col("x")), x="\t a b \n") == "a b"
    assert one(spark, text.escape_html(F.col("x")), x='<a&"b">') == "&lt;a&amp;&quot;b&quot;&gt;"


@pytest.mark.parametrize(
    "asked, want",
    [("see shop-peche.com/x", "shop-peche.com"), ("https://a.com:8080/x", "a.com:8080"), ("HTTP://WWW.Foo.co.uk?x", "foo.co.uk"), ("no host", None), ("", None), ("a.b.", "a.b")],
)
def test_host(spark, asked, want):
    assert one(spark, text.extract_host(F.col("x")), x=asked) == want


def test_domains(spark):
    of = lambda x: one(spark, text.candidate_domains(F.col("x"), text.normalize_name(F.col("x"))), x=x)
    assert of("Realisation Par") == ["realisationpar.com", "realisation-par.com", "therealisationpar.com", "realisationpar.co", "realisationparstudio.com"]
    assert of("Foo London") == ["foolondon.com", "foo-london.com", "thefoolondon.com", "foolondon.co", "foolondon.co.uk", "foolondonstudio.com"]
    assert of("!!") == []
    assert one(spark, text.registrable_label(F.col("x")), x="www.shop-peche.com") == "shoppeche"


@pytest.mark.parametrize(
    "asked, domain, want",
    [("https://www.shop-peche.com/x", "shop-peche.com", "Shoppeche"), ("LA apparel co", "x.com", "LA Apparel Co"), ("shoppeche shoppeche.com", "shoppeche.com", "Shoppeche Shoppeche.com"), ("foo.com", "foo.com", "Foo.com")],
)
def test_display_name(spark, asked, domain, want):
    assert one(spark, text.display_name(F.col("x"), F.col("d")), x=asked, d=domain) == want


@pytest.mark.parametrize("asked, domain, want", [("shop asos", None, True), ("beth miller", None, True), ("x", "zara.com", True), ("H & M", None, True), ("Niche", "niche.com", False), ("free people", None, True)])
def test_denied(spark, asked, domain, want):
    assert one(spark, text.is_denied(text.normalize_name(F.col("x")), F.col("d").cast("string")), x=asked, d=domain) == want


def test_prices(spark):
    price = lambda *ps: one(spark, products.first_price(F.array(*[F.struct(F.lit(p).cast("string").alias("price")) for p in ps])))
    assert price(None, "", "x", "12.5", "9") == 12.5
    assert price("0.00", "9") == 0.0
    assert price("nan", "x") is None
    assert one(spark, products.first_price(F.lit(None).cast("array<struct<price: string>>"))) is None
    for p, want in ((110.5, 110), (111.5, 112), (0.4, 0)):
        assert one(spark, products.usd(F.col("p"), F.lit(None).cast("double")), p=p) == want


def test_price_drops(spark):
    drop = lambda now, then: one(spark, money.meaningful_drop(F.col("n"), F.col("t")), n=now, t=then)
    assert drop(90.0, 100.0) and not drop(18.0, 20.0) and not drop(91.0, 100.0)
    assert drop("90", "100") and not drop("x", "100") and not drop("nan", "100") and not drop("100", "nan") and not drop("-5", "0")
    assert one(spark, money.sale_percent(F.col("n"), F.col("t")), n=71.0, t=100.0) == 28


@pytest.mark.parametrize("x", [75.0, 79.5, 0.0, 1234567.0, 73371.05, 60692.85, 59113.35, 0.1, 0.015625, 999999.5, 100000.0, 12.3456789, 5e-3, 1e9, 2.5, 104.999999])
def test_price_text(spark, x):
    assert one(spark, money.price_text(F.col("x")), x=x) == f"{x:g}"


def test_sizes(spark):
    options = lambda name, values: F.array(F.struct(F.lit(name).alias("name"), F.lit(2).alias("position"), F.array(*map(F.lit, values)).alias("values")))
    variants = lambda *sizes: F.array(*[F.struct(F.lit(a).alias("available"), F.lit("x").alias("option1"), F.lit(s).cast("string").alias("option2"), F.lit(None).cast("string").alias("option3")) for s, a in sizes])
    of = lambda name, values, *sizes: one(spark, products.available_sizes(options(name, values), variants(*sizes)))
    assert of(" Size", ["L", "S", "2XL"], ("L", True), ("S", True), ("2XL", True), ("M", False)) == ["S", "L", "2XL"]
    assert of("sizes", ["36", "38", "40"], ("38", True), ("36", True), ("one", True), ("38", True), (None, True)) == ["36", "38", "one"]
    assert of("Color", ["a"], ("L", True)) == []
    assert of("size", ["a"], ("L", False)) == []
    assert [one(spark, products.canon_size(F.col("s")), s=s) for s in ("Medium", "X-Large", "2 XL", "weird One")] == ["m", "xl", "xxl", "weirdone"]
    assert one(spark, products.distinct_sizes(F.array(F.lit(" M "), F.lit("m"), F.lit(""), F.lit(None).cast("string"), F.lit("L")))) == ["M", "L"]
    array = lambda xs: F.array(*map(F.lit, xs))
    missing = lambda a, b: one(spark, products.sizes_missing(array(a), products.canon_sizes(array(a)), products.canon_sizes(array(b))))
    assert missing(["Medium", "L", "L"], ["M"]) == ["L", "L"] and missing(["M"], ["Medium", "L"]) == []


def test_images(spark):
    images = F.array(*[F.struct(F.lit(s).cast("string").alias("src")) for s in ("", None, "a", "b", "a", "c", "d", "e", "f")])
    assert one(spark, products.first_image(images)) == "a"
    assert one(spark, products.gallery(images)) == ["a", "b", "c", "d", "e"]
    assert one(spark, products.gallery(F.lit(None).cast("array<struct<src: string>>"))) == []


RAW, REDIRECTED = "https://shop.example/products/a dress*~é", links.REDIRECT + "?key=k1&u=https%3A%2F%2Fshop.example%2Fp&cuid=c"
TEMPLATE = "https://go.example/?id=1&ued={url}"


def wrapped(spark, url, template=None, key="", campaign="app"):
    columns = [F.lit(v).cast("string") for v in (url, template, key, campaign)]
    return one(spark, links.wrap(*columns))


def test_links(spark):
    from urllib.parse import quote, urlencode

    assert wrapped(spark, RAW) == RAW
    redirect = links.REDIRECT + "?" + urlencode({"key": "k&1", "u": RAW, "cuid": "app"})
    assert wrapped(spark, RAW, key="k&1") == redirect and wrapped(spark, redirect, key="k&1") == redirect
    by_template = wrapped(spark, RAW, TEMPLATE, "k")
    assert by_template == TEMPLATE.replace("{url}", quote(RAW, safe="")) and wrapped(spark, by_template, TEMPLATE, "k") == by_template
    assert wrapped(spark, REDIRECTED, TEMPLATE) == TEMPLATE.replace("{url}", quote("https://shop.example/p", safe=""))
    assert wrapped(spark, RAW, "https://no.example/") == RAW
    assert wrapped(spark, None, TEMPLATE, "k") is None and wrapped(spark, "", TEMPLATE, "k") == ""
    assert one(spark, links.unwrap(F.col("u")), u=links.REDIRECT + "?u=%zz") == links.REDIRECT + "?u=%zz"


def test_times(spark):
    now = F.lit("2024-01-20 12:00:00").cast("timestamp")
    at = lambda f, x: one(spark, f(times.parse(F.col("x").cast("string"))), x=x)
    active = lambda t: times.recently_active(t, now)
    assert at(active, "2024-01-18 12:00:01") and not at(active, "2024-01-18 12:00:00") and not at(active, None) and not at(active, "x")
    seen = lambda t: times.seen_within(t, F.lit(None).cast("timestamp"), now)
    assert at(seen, "2024-01-13T12:00:00Z") and not at(seen, "2024-01-13 11:59:59") and not at(seen, None)
    assert at(lambda t: times.pushed_today(t, now), "2024-01-20 00:00:00") and not at(lambda t: times.pushed_today(t, now), "2024-01-19 23:59:59")
    resend = lambda x: one(spark, times.needs_resend(F.col("x").cast("string"), now), x=x)
    assert resend(None) and resend("") and resend("2024-01-06 12:00:00") and not resend("2024-01-06 12:00:01") and not resend("soon")


def test_vectors(spark):
    v = F.array(F.lit(3.0), F.lit(4.0))
    assert one(spark, vectors.l2_normalize(v)) == [0.6, 0.8] and one(spark, vectors.norm(v)) == 5.0
    assert one(spark, vectors.l2_normalize(F.array(F.lit(0.0)))) == [0.0]
    assert one(spark, vectors.quantize(F.array(F.lit(2.0), F.lit(-2.0), F.lit(0.5 / 127), F.lit(1.0)))) == [127, -127, 0, 127]


def test_rule_tables():
    assert len(rules.DENIED_NAMES) == len(set(rules.DENIED_NAMES)) == 79
    assert len(rules.DENIED_PHRASES) == 20 and len(rules.JUNK_TITLE_PHRASES) == 45 and len(rules.FX_TO_USD) == 9
