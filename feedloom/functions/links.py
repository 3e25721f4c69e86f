"""Wrapping and unwrapping of affiliate links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules

REDIRECT = rules.REDIRECT


def quote(x: Column) -> Column:
    """Percent-encoded, all but letters, digits and ``_.-~``."""
    return F.replace(form_encode(x), F.lit("+"), F.lit("%20"))


def form_encode(x: Column) -> Column:
    """As ``quote``, spaces as plus signs."""
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def unwrap(url: Column, redirect: str = REDIRECT) -> Column:
    """The target of a redirect link; any other link as it is."""
    target = F.try_url_decode(F.regexp_extract(url, "[?&]u=([^&#]*)", 1))
    return F.when(url.startswith(redirect) & (F.coalesce(target, F.lit("")) != ""), target).otherwise(url)


def wrap(url: Column, template: Column, key: Column, campaign: Column, redirect: str = REDIRECT) -> Column:
    """The link that pays: by the brand's template (with ``{url}``), else by the redirect if there is a key, else as it is.

    What is already wrapped the same way stays; a redirect is unwrapped before a template wraps it.
    """
    template = F.when(template.contains("{url}"), template)
    prefix = F.substring_index(template, "{url}", 1)
    by_template = F.when((prefix != "") & F.startswith(url, prefix), url).otherwise(F.replace(template, F.lit("{url}"), quote(unwrap(url, redirect))))
    query = F.concat(F.lit("key="), form_encode(key), F.lit("&u="), form_encode(url), F.when(F.coalesce(campaign, F.lit("")) != "", F.concat(F.lit("&cuid="), form_encode(campaign))).otherwise(""))
    by_redirect = F.when(F.startswith(url, F.lit(redirect)), url).otherwise(F.concat(F.lit(redirect + "?"), query))
    return F.when(F.coalesce(url, F.lit("")) == "", url).when(template.isNotNull(), by_template).when(F.coalesce(key, F.lit("")) == "", url).otherwise(by_redirect)
