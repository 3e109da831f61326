"""Column functions on urls and page text, all built in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\t\n\r\f]+"


def host_of(url: Column) -> Column:
    """Key of a site: lower case, without scheme, user, port, path, trailing dot and one leading www. or m.; null if empty or without a dot."""
    h = F.lower(F.trim(url))
    for pattern in (r"^[a-z][a-z0-9+.-]*://", r"^[^/?#@]*@", r"[/?#](?s:.*)$", r":[0-9]*$", r"\.+$", r"^(www|m)\."):
        h = F.regexp_replace(h, pattern, "")
    return F.when(h.contains("."), h)


def title_of(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), SPACE, " "))


def text_of(html: Column) -> Column:
    """Page text: scripts and styles, then tags, become blanks; runs of blanks become one."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), SPACE, " "))


def excerpt_of(html: Column, chars: int) -> Column:
    return F.substring(text_of(html), 1, chars)


def links_of(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""(?i)href="([^"]*)\""""), 1)


def padded_words(text: Column) -> Column:
    """Lower-case runs of a-z and 0-9, each between single blanks: a term is whole if it stands between blanks."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), F.lit(" "))


def words_of(text: Column) -> Column:
    return F.filter(F.split(padded_words(text), " "), lambda x: x != "")
