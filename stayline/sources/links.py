"""Links in stored HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two phrases that mark the link to the decisions file.
LINK_PHRASES = ("Visa decisions made from", "January")

_NOT_SHOWN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
_ANCHOR = r"(?is)<a\b([^>]*)>(.*?)</a>"
# The attribute itself, quoted or not; not the end of another one's name.
_HREF = r"(?is)(?:^|[\s\"'])href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_NUMBERED = "&#([0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"
# The named character references that occur in link texts.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def _character(number: Column) -> Column:
    """The character of a decimal or ``x`` and hexadecimal number; U+FFFD where there is none."""
    code = F.when(F.lower(number).startswith("x"), F.conv(F.substring(number, 2, 6), 16, 10)).otherwise(number).cast("bigint")
    known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(known, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")


def unescape(text: Column) -> Column:
    numbers = F.array_distinct(F.regexp_extract_all(text, F.lit(_NUMBERED), F.lit(1)))
    text = F.aggregate(numbers, text, lambda acc, n: F.replace(acc, F.concat(F.lit("&#"), n, F.lit(";")), _character(n)))
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def anchors(pages: DataFrame) -> DataFrame:
    """Every anchor of every page with its place, link and text. Comments, scripts and styles are not read."""
    shown = F.regexp_replace("html", _NOT_SHOWN, "")
    pair = F.arrays_zip(
        F.regexp_extract_all(shown, F.lit(_ANCHOR), F.lit(1)).alias("attributes"),
        F.regexp_extract_all(shown, F.lit(_ANCHOR), F.lit(2)).alias("inner"),
    )
    text = F.trim(unescape(F.regexp_replace(F.col("a.inner"), "<[^>]*>", "")))
    return pages.select("page_id", "url", F.posexplode(pair).alias("pos", "a")).select(
        "page_id",
        "url",
        "pos",
        unescape(F.concat(*[F.regexp_extract(F.col("a.attributes"), _HREF, n) for n in (1, 2, 3)])).alias("href"),
        text.alias("text"),
    )


def _without_dots(path: Column) -> Column:
    """A path with ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/")
    ended = F.element_at(parts, -1).isin(".", "..")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p == ".", acc)
        .when(p == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.array_append(acc, p)),
    )
    return F.concat(F.array_join(kept, "/"), F.when(ended, "/").otherwise(""))


def resolve(base: Column, href: Column) -> Column:
    """An absolute link from a base address and a link: absolute, scheme-, root- and directory-relative,
    dot segments, query-only and fragment-only forms."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    host = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    raw_path = F.substring(page, F.length(host) + 1, F.length(page))
    path = F.when(raw_path == "", "/").otherwise(raw_path)
    folder = F.regexp_replace(path, r"[^/]*$", "")
    target = F.regexp_extract(href, r"^([^?#]*)", 1)
    tail = F.substring(href, F.length(target) + 1, F.length(href))
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(host, _without_dots(target), tail))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .otherwise(F.concat(host, _without_dots(F.concat(folder, target)), tail))
    )


def links(pages: DataFrame) -> DataFrame:
    return anchors(pages).withColumn("link", resolve(F.col("url"), F.col("href")))


def first_link(pages: DataFrame, phrases: tuple[str, ...] = LINK_PHRASES) -> DataFrame:
    """Per page, the first anchor whose text holds all the phrases; its text is the period label."""
    matching = anchors(pages)
    for phrase in phrases:
        matching = matching.where(F.col("text").contains(phrase))
    return (
        matching.groupBy("page_id", "url")
        .agg(F.min_by("href", "pos").alias("href"), F.min_by("text", "pos").alias("period_label"))
        .select("page_id", resolve(F.col("url"), F.col("href")).alias("link"), "period_label")
    )
