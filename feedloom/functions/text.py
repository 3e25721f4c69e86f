"""Text functions: columns in, columns out."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rules


def blank(x: Column) -> Column:
    """Null read as an empty string."""
    return F.coalesce(x, F.lit(""))


#: What counts as white space at the ends of a text.
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(x: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.btrim(x, F.lit(WHITE_SPACE))


def normalize_type(x: Column) -> Column:
    """A product type as lower-case words between single spaces."""
    return F.trim(F.regexp_replace(F.lower(blank(x)), "[^a-z0-9]+", " "))


def brand_key(x: Column) -> Column:
    """A brand's name for comparison: some accents folded, then letters a-z and digits only."""
    return F.regexp_replace(F.translate(F.lower(blank(x)), *rules.ACCENTS), "[^a-z0-9]", "")


def brand_keys(names: list[str]) -> list[str]:
    """``brand_key`` of constants."""
    fold = str.maketrans(*rules.ACCENTS)
    return list(dict.fromkeys(re.sub("[^a-z0-9]", "", n.lower().translate(fold)) for n in names))


@F.pandas_udf(T.StringType())
def _without_accents(x: pd.Series) -> pd.Series:
    fold = lambda s: "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).lower()
    return x.map(fold, na_action="ignore")


def normalize_name(x: Column) -> Column:
    """Lower-case words without accents. Spark has no NFKD: text beyond ASCII goes through Arrow."""
    folded = F.when(x.rlike(r"^\p{ASCII}*$"), F.lower(x)).otherwise(_without_accents(x))
    return F.trim(F.regexp_replace(blank(folded), "[^a-z0-9]+", " "))


def slugify(x: Column) -> Column:
    """Every character that isn't a letter or a number becomes a hyphen; none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(blank(x)), r"[^\p{L}\p{N}]", "-"), "^-+|-+$", "")


def has_word(x: Column, words: list[str]) -> Column:
    return x.rlike(rules.words_pattern(words))


def infer_category(product_type: Column, title: Column) -> Column:
    text = F.lower(F.concat(blank(product_type), F.lit(" "), blank(title)))
    out = F.lit(rules.DEFAULT_CATEGORY)
    for category, words in reversed(rules.CATEGORY_RULES):
        out = F.when(has_word(text, words), F.lit(category)).otherwise(out)
    return out


def _colors_in(text: Column) -> Column:
    found = F.array(*[F.when(text.rlike(rules.parts_pattern(words)), F.lit(tag)) for tag, words in rules.COLOR_RULES])
    return F.slice(F.filter(found, lambda c: c.isNotNull()), 1, rules.COLORS_KEPT)


def infer_colors(title: Column, product_type: Column, tags: Column | None = None, options: Column | None = None) -> Column:
    """Up to two colours: of title and type; if they name none, of tags and colour options.

    ``tags`` is an array of strings, ``options`` an array of (name, position, values).
    """
    shown = _colors_in(F.lower(F.concat(blank(title), F.lit(" "), blank(product_type))))
    other = F.lit("")
    if tags is not None:
        other = F.concat(other, F.lit(" "), blank(F.lower(F.array_join(tags, " "))))
    if options is not None:
        named = F.filter(F.coalesce(options, F.array()), lambda o: F.lower(blank(o["name"])).rlike("colou?r"))
        values = F.flatten(F.transform(named, lambda o: F.coalesce(o["values"], F.array().cast("array<string>"))))
        other = F.concat(other, F.lit(" "), blank(F.lower(F.array_join(values, " "))))
    behind = _colors_in(other)
    return F.when(F.size(shown) > 0, shown).when(F.size(behind) > 0, behind).otherwise(F.array(*map(F.lit, rules.DEFAULT_COLORS)))


def base_name(title: Column) -> Column:
    """A title without the colour of the variant."""
    text = F.lower(blank(title))
    colors = rules.color_words()
    known = F.array(*map(F.lit, colors))
    cuts = []
    for sep in rules.SEPARATORS:
        at = F.instr(text, sep)
        words = F.regexp_extract_all(F.substr(text, at + len(sep), F.length(text)), F.lit("[a-z]+"), F.lit(0))
        colorful = F.forall(words, lambda w: F.array_contains(known, w))
        cuts.append(F.when((at > 0) & (F.size(words) > 0) & ((F.size(words) <= 2) | colorful), F.substr(text, F.lit(1), at - 1)))
    cut = F.coalesce(*cuts, text)
    one = "(?:" + rules.parts_pattern(colors) + ")"
    inside = rf"\([^a-z)]*(?:{one}(?:[^a-z)]+{one})*[^a-z)]*)?\)|(\([^)]*\))"
    tokens = F.array_join(F.regexp_extract_all(F.regexp_replace(cut, inside, "$1"), F.lit("[a-z0-9']+"), F.lit(0)), " ")
    bare = F.trim(F.regexp_replace(tokens, f"(?:(?:^| ){one})+$", ""))
    return F.when(bare != "", bare).otherwise(F.lower(strip(blank(title))))


def registrable_label(domain: Column) -> Column:
    """The first label of a domain, without ``www.``."""
    return F.regexp_replace(F.get(F.split(F.regexp_replace(F.lower(domain), r"^www\.", ""), r"\."), F.lit(0)), "[^a-z0-9]", "")


def extract_host(text: Column) -> Column:
    """The host of the first URL, or of the first thing that looks like a domain; else null."""
    url = F.regexp_extract(text, r"(?i)https?://([^/\s]+)", 1)
    bare = F.regexp_extract(text, r"(?i)\b([a-z0-9](?:[a-z0-9\-]*[a-z0-9])?(?:\.[a-z0-9\-]+)+)\b", 1)
    host = F.regexp_extract(F.when(url != "", url).otherwise(bare), "^[^/?#]*", 0)
    host = F.regexp_replace(F.regexp_replace(F.lower(host), r"^www\.", ""), r"^\.+|\.+$", "")
    return F.when(host.contains("."), host)


def candidate_domains(name: Column, normalized: Column) -> Column:
    """Up to six domains that a brand of this name may have, likeliest first."""
    joined, hyphened = F.replace(normalized, F.lit(" "), F.lit("")), F.replace(normalized, F.lit(" "), F.lit("-"))
    low = F.lower(blank(name))
    any_of = lambda *parts: low.rlike(rules.parts_pattern(list(parts)))
    made = F.array(
        F.concat(joined, F.lit(".com")),
        F.concat(hyphened, F.lit(".com")),
        F.concat(F.lit("the"), joined, F.lit(".com")),
        F.concat(joined, F.lit(".co")),
        F.when(any_of("uk", "london", "britain", ".co.uk"), F.concat(joined, F.lit(".co.uk"))),
        F.when(any_of("australia", ".au", "au)", " au"), F.concat(joined, F.lit(".com.au"))),
        F.concat(joined, F.lit("studio.com")),
    )
    out = F.slice(F.array_distinct(F.filter(made, lambda d: d.isNotNull())), 1, 6)
    return F.when(normalized != "", out).otherwise(F.array().cast("array<string>"))


def capitalize(x: Column) -> Column:
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2), F.length(x))))


def display_name(text: Column, domain: Column) -> Column:
    """A brand's name to show: of its domain where the request is only that, else its words with capitals."""
    host, label = extract_host(blank(text)), blank(registrable_label(domain))
    cleaned = strip(F.regexp_replace(blank(text), r"https?://\S+", ""))
    named = normalize_name(cleaned)
    words = F.regexp_extract_all(label, F.lit("[a-z]+|[0-9]+"), F.lit(0))
    of_label = F.when(F.size(words) > 0, F.array_join(F.transform(words, capitalize), " ")).otherwise(capitalize(label))
    name = F.when(cleaned != "", cleaned).otherwise(blank(text))
    tokens = F.filter(F.split(strip(name), r"(?U)\s+"), lambda w: w != "")
    keep = lambda w: F.when((F.upper(w) == w) & (F.lower(w) != w), w).otherwise(capitalize(w))
    return F.when(host.isNotNull() & ((named == "") | (named == label)), of_label).otherwise(F.array_join(F.transform(tokens, keep), " "))


def is_denied(normalized: Column, domain: Column) -> Column:
    """Whether a request is for a shop on the deny list: by domain, by name, by a word, or by a phrase inside."""
    denied = rules.DENIED_NAMES
    words = F.split(normalized, " ")
    return (
        F.coalesce(registrable_label(domain).isin(denied), F.lit(False))
        | F.replace(normalized, F.lit(" "), F.lit("")).isin(denied)
        | F.arrays_overlap(words, F.array(*map(F.lit, denied)))
        | normalized.rlike(rules.parts_pattern(rules.DENIED_PHRASES))
    )


def escape_html(x: Column) -> Column:
    out = blank(x)
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(sign), F.lit(entity))
    return out
