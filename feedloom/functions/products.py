"""Functions of a raw product's nested fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .text import WHITE_SPACE, blank, has_word, normalize_type, strip

STRINGS = "array<string>"


def is_junk(title: Column, price: Column, product_type: Column) -> Column:
    """Whether a product is a gift card, a fee, a size chart or another thing that isn't worn."""
    text, kind = F.lower(blank(title)), normalize_type(product_type)
    cheap = F.coalesce(price < rules.JUNK_PRICE_FLOOR, F.lit(False))
    return (text == "") | has_word(text, rules.JUNK_TITLE_PHRASES) | has_word(kind, rules.JUNK_TYPE_PHRASES) | (cheap & has_word(text, rules.JUNK_ADDON_WORDS))


def _sources(images: Column) -> Column:
    return F.filter(F.transform(F.coalesce(images, F.array()), lambda i: i["src"]), lambda s: s.isNotNull() & (s != ""))


def first_image(images: Column) -> Column:
    return F.get(_sources(images), F.lit(0))


def gallery(images: Column, n: int = 5) -> Column:
    return F.slice(F.array_distinct(_sources(images)), 1, n)


def first_price(variants: Column) -> Column:
    """The first variant price that is given and is a number."""
    prices = F.transform(F.filter(F.coalesce(variants, F.array()), lambda v: blank(v["price"]) != ""), lambda v: strip(v["price"]).try_cast("double"))
    return F.get(F.filter(prices, lambda p: p.isNotNull() & ~F.isnan(p)), F.lit(0))


def usd(price: Column, rate: Column) -> Column:
    """In whole dollars, halves to the even one; an unknown rate is 1. Null if that is no whole number that fits."""
    return F.rint(price * F.coalesce(rate, F.lit(1.0))).try_cast("int")


def size_rank(size: Column) -> Column:
    """The place of a letter size on its scale, or null."""
    scale = F.create_map(*[F.lit(x) for pair in rules.SIZE_RANKS.items() for x in pair])
    return F.try_element_at(scale, F.replace(F.upper(strip(size)), F.lit(" "), F.lit("")))


def order_sizes(in_stock: Column, declared: Column) -> Column:
    """Letter sizes by their scale; others in the order declared, then as they come."""
    declared = F.transform(F.coalesce(declared, F.array().cast(STRINGS)), strip)
    ranked = F.transform(F.array_sort(F.transform(in_stock, lambda s, i: F.struct(size_rank(s).alias("r"), i.alias("i"), s.alias("s")))), lambda x: x["s"])
    listed = F.concat(F.filter(declared, lambda s: F.array_contains(in_stock, s)), F.filter(in_stock, lambda s: ~F.array_contains(declared, s)))
    return F.when(F.forall(in_stock, lambda s: size_rank(s).isNotNull()), ranked).otherwise(listed)


def available_sizes(options: Column, variants: Column) -> Column:
    """Sizes in stock, without repeats, in order; none if there is no size option."""
    option = F.get(F.filter(F.coalesce(options, F.array()), lambda o: F.lower(strip(blank(o["name"]))).isin("size", "sizes")), F.lit(0))
    place = F.coalesce(option["position"], F.lit(1))
    value = lambda v: F.when(place == 1, v["option1"]).when(place == 2, v["option2"]).when(place == 3, v["option3"])
    sold = F.filter(F.coalesce(variants, F.array()), lambda v: F.coalesce(v["available"], F.lit(False)))
    in_stock = F.array_distinct(F.filter(F.transform(sold, lambda v: strip(value(v))), lambda s: s.isNotNull() & (s != "")))
    return F.when(option.isNotNull(), order_sizes(in_stock, option["values"])).otherwise(F.array().cast(STRINGS))


def canon_size(size: Column) -> Column:
    """One name for the spellings of a size."""
    key = F.translate(F.lower(size), WHITE_SPACE + "._-", "")
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in rules.SIZE_NAMES.items() for x in pair]), key), key)


def distinct_sizes(sizes: Column) -> Column:
    """Sizes that aren't blank; of those that differ in case only, the first."""
    given = F.filter(F.transform(F.coalesce(sizes, F.array().cast(STRINGS)), strip), lambda s: s.isNotNull() & (s != ""))
    low = F.transform(given, F.lower)
    firsts = F.filter(given, lambda s, i: F.array_position(low, F.lower(s)) == i + 1)
    return F.when(F.size(F.array_distinct(low)) == F.size(low), given).otherwise(firsts)


def canon_sizes(sizes: Column) -> Column:
    return F.transform(sizes, canon_size)


def sizes_missing(of: Column, of_canon: Column, there_canon: Column) -> Column:
    """Sizes of one list that the other has under no spelling; repeats stay.

    Takes both lists' ``canon_sizes`` as columns of their own, so that they
    aren't made again for each size.
    """
    return F.filter(of, lambda s, i: ~F.array_contains(there_canon, F.get(of_canon, i)))


def samples(products: Column, currency: Column, n: int = 3) -> Column:
    """The first ``n`` products with a name and an image: (name, price as text, image)."""
    made = F.transform(
        F.coalesce(products, F.array()),
        lambda p: F.struct(
            strip(blank(p["title"])).alias("name"),
            F.coalesce(F.concat(currency, F.lit(" "), F.rint(first_price(p["variants"])).try_cast("long").cast("string")), F.lit("")).alias("price"),
            first_image(p["images"]).alias("image"),
        ),
    )
    return F.slice(F.filter(made, lambda s: (s["name"] != "") & s["image"].isNotNull()), 1, n)
