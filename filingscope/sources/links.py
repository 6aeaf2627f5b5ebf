"""Links on web pages: every anchor, and those that lead to filing archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingscope.functions.text import archive_year

HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
VALUE = r"(?:\"[^\"]*\"|'[^']*'|[^\s>\"']+)"
ANCHOR = r"(?is)<a\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?=</a\s*>|<a\s|$)"
HREF = (
    r"(?is)^<a(?:\s+(?!href\s*=)[^\s=>]+(?:\s*=\s*" + VALUE + r")?)*\s+href\s*=\s*"
    r"(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
)
TAG = r"(?s)<(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"

# The named characters that links use; the ampersand comes last, so that nothing is read twice.
NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def unescaped(text: Column) -> Column:
    for name, character in NAMED:
        text = F.replace(text, F.lit(name), F.lit(character))
    return text


def page_links(pages: DataFrame) -> DataFrame:
    """Anchors with a target on each page: position, href, label without tags, absolute URL.

    Comments, scripts and styles hold no anchors. The target may stand in either kind of quotes or in none.
    """
    shown = F.regexp_replace("html", HIDDEN, "")
    found = F.filter(F.regexp_extract_all(shown, F.lit(ANCHOR), F.lit(0)), lambda a: a.rlike(HREF))
    anchors = pages.select("page_id", "url", F.posexplode(found).alias("position", "anchor"))
    target = F.concat(*[F.regexp_extract("anchor", HREF, group) for group in (1, 2, 3)])
    href = F.trim(unescaped(target))
    label = F.trim(unescaped(F.regexp_replace("anchor", TAG, "")))
    return anchors.select(
        "page_id",
        "position",
        href.alias("href"),
        label.alias("label"),
        absolute_url(F.col("url"), href).alias("link"),
    )


def absolute_url(page_url: Column, href: Column) -> Column:
    """``href`` itself if it is absolute, else below the page's host."""
    origin = F.regexp_extract(page_url, r"^([a-zA-Z]+://[^/]+)", 1)
    below = F.when(href.startswith("/"), href).otherwise(F.concat(F.lit("/"), href))
    return F.when(href.startswith("http"), href).otherwise(F.concat(origin, below))


def archive_links(pages: DataFrame, first_year: int = 2020, exclude: str = "exempt") -> DataFrame:
    """Links to filing archives: ``.zip``, not labelled with the excluded phrase, from ``first_year`` on."""
    return (
        page_links(pages)
        .where(F.lower("href").endswith(".zip") & ~F.lower("label").contains(exclude.lower()))
        .withColumn("year", archive_year(F.col("href")))
        .where(F.col("year") >= first_year)
    )
