"""URL rules whose block decisions reach all redirect-equivalent pages."""

from __future__ import annotations

import html
import re
import string
from typing import NamedTuple
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwise.llm.components import components
from starwise.llm.text import map_slices
from starwise.runtime import materialize


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching(host: Column, path: Column, rules: list[Rule], give: str) -> Column:
    """``give`` (name or verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, give))).otherwise(out)
    return out


def same_page(url: Column) -> Column:
    """The form that spellings of one address share, null for what is no address.

    Without scheme, ``www.``, a default port, fragment, tracking parameters and final slashes:
    servers redirect between those.
    """
    host = F.regexp_replace(host_of(url), r"^www\.|:(80|443)$", "")
    query = F.regexp_extract(url, r"(?s)://[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|gclid|fbclid)="))
    rest = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    form = F.concat(host, F.regexp_replace(path_of(url), r"/+$", ""), rest)
    return F.when(url.contains("://"), form)


# A page without these words has no link to follow.
_HINT = "(?i)canonical|refresh|og:url"
_TAG = re.compile(r"""<(link|meta|base)\b((?:[^>"']++|"[^"]*+"|'[^']*+')*+(?=>)|[^>]*)>""", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_REFRESH = re.compile(r"""\s*[0-9.]+(?:\s*[;,]\s*|\s+)(?:url\s*=\s*)?(?:"([^"]*)"?|'([^']*)'?|(.*))$""", re.I | re.S)
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:")


def resolve(base: str, address: str) -> str | None:
    """The absolute form of an address met at ``base``, by the rules of RFC 3986; null if it names no page."""
    address = address.strip()
    if not address:
        return None
    if _SCHEME.match(address):
        return address if address.startswith("://", _SCHEME.match(address).end() - 1) else None
    scheme, rest = base.split("://", 1)
    try:
        return scheme + urljoin(f"http://{rest}", address).removeprefix("http")  # any scheme is resolved alike
    except ValueError:  # no valid host
        return None


def links_of(page: str, url: str) -> list[str]:
    """Absolute addresses of the redirects and canonical links in a page.

    Entities in attributes are decoded; relative targets are resolved against the first ``base``
    and the page's address.
    """
    base, found = None, []
    for tag, inside in _TAG.findall(page):
        values: dict[str, str] = {}
        for name, *value in _ATTRIBUTE.findall(inside):
            values.setdefault(name.lower(), html.unescape("".join(value)))
        if tag.lower() == "base":
            base = base or (resolve(url, values["href"]) if "href" in values else None)
        elif tag.lower() == "link":
            if "canonical" in values.get("rel", "").lower().split():
                found.append(values.get("href", ""))
        elif values.get("http-equiv", "").strip().lower() == "refresh":
            if target := _REFRESH.match(values.get("content", "")):
                found.append("".join(filter(None, target.groups())))
        elif values.get("property", "").strip().lower() == "og:url":
            found.append(values.get("content", ""))
    resolved = [resolve(base or url, address) for address in found]
    return [link for link in resolved if link]


def page_links(pages: DataFrame) -> DataFrame:
    """(``url``, ``link``) for every redirect and canonical link of ``pages``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(batch.column("url").to_pylist(), batch.column("html").to_pylist())
        found = [(url, link) for url, page in rows for link in links_of(page, url)]
        columns = [pa.array([row[n] for row in found], pa.string()) for n in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, ["url", "link"])

    asked = pages.where(F.col("url").contains("://") & F.col("html").rlike(_HINT))
    return map_slices(asked.select("url", "html"), work, "url string, link string")


def _node(form: Column) -> Column:
    return F.unhex(F.md5(form))


def judge_pages(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` for every row of ``pages``.

    A page with a fitting rule gets the longest rule's verdict, so an explicit allow stands against
    any alias. Any other page is blocked if a block rule fits one of its aliases: spellings of
    its address, pages it redirects to or names as canonical, and those that do so in turn
    (connected components over all these links); else it is allowed. ``rules`` is a short list.
    Nulls: a null url, or one without ``://``, has an empty host and path and no alias; a null
    html has no links. Repeated rows come back as they are; other columns are not read.
    """
    url = F.col("url")
    read = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"), same_page(url).alias("form"))
    read = read.withColumn("rule", matching(F.col("host"), F.col("path"), rules, "name"))
    read = read.withColumn("said", matching(F.col("host"), F.col("path"), rules, "verdict"))

    linked = page_links(pages).select(_node(same_page(url)).alias("a"), _node(same_page(F.col("link"))).alias("b"), "link")
    linked = materialize(linked.where("a <> b"))
    labels = components(linked.select("a", "b"))

    own = read.where("said = 'block'").select(_node(F.col("form")).alias("node"))
    target = matching(host_of(F.col("link")), path_of(F.col("link")), rules, "verdict")
    blocked = own.union(linked.where(target == "block").select("b")).distinct()
    blocked = blocked.join(labels, "node", "left").select(F.coalesce("label", "node").alias("group")).distinct()

    # only pages without a rule ask their group; the others get a node of their own, spread out
    asks = F.when(F.col("said").isNull(), _node(F.col("form")))
    node = F.coalesce(asks, F.unhex(F.md5(F.concat(F.lit("page "), F.xxhash64("page_id", "url").cast("string")))))
    asked = read.withColumn("node", node).join(labels, "node", "left").withColumn("group", F.coalesce("label", "node"))
    judged = asked.join(blocked.withColumn("hit", F.lit("block")), "group", "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("said", "hit", F.lit("allow")).alias("verdict"))
