"""URL verdicts: rules on host and path, carried over to redirect and canonical aliases.

Pages that redirect to one another or name a canonical address are one thing under several addresses.  The
connected components of these links are found by star contractions; a block decision on any address holds for
all its aliases that no rule names, unless one of them is explicitly allowed.
"""

from __future__ import annotations

import html as html_entities
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from etalage.llm.common import fresh, on_arrow, written
from etalage.llm.components import components


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
_CANONICAL = (r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?\s*canonical\b)[^>]*?\bhref\s*=\s*["']?\s*([^"'\s>]+)""")
_REFRESH = (r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?\s*refresh\b)[^>]*?\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*([^"'\s>]+)""")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://``, cut at the first / ? or #; both empty for null or without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def node_of(url: Column) -> Column:
    """The address without scheme and fragment; null where there is no host."""
    host, _ = host_and_path(url)
    node = F.concat(host, F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^#]*)", 1))
    return F.when(F.length(node) > 0, node)


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """(rule, verdict) of the longest fitting rule, else null; of equally long ones the allowing one.

    ``rules`` is a list of the caller's, part of the plan, and does not grow with the pages.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), r.verdict != "allow", r.host, r.path))
    fitting = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                      F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in ordered]
    none = F.lit(None).cast("struct<rule: string, verdict: string>")
    return F.coalesce(*fitting, none)


_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:")
_PARTS = re.compile(r"(?s)([^/?]*)([^?]*)(.*)")


def _without_dots(path: str) -> str:
    """The path without its ``.`` and ``..`` segments."""
    out: list[str] = []
    segments = path.split("/")[1:]
    for i, segment in enumerate(segments):
        if segment == "..":
            del out[-1:]
        if segment not in (".", ".."):
            out.append(segment)
        elif i == len(segments) - 1:
            out.append("")
    return "/" + "/".join(out)


def target_of(page: str, link: str) -> str | None:
    """Where a link in the page at ``page`` leads, as browsers resolve it; null if not to a place on a host.

    The link is as it stands in the page, with HTML entities; links within the page are null as well.
    """
    link = html_entities.unescape(link).strip().split("#", 1)[0]
    scheme = _SCHEME.match(link)
    rest = link[scheme.end():] if scheme else link
    if not link or scheme and not rest.startswith("//"):
        return None
    if rest.startswith("//"):
        host, path, query = _PARTS.fullmatch(rest[2:]).groups()
    else:
        host, folder, query = _PARTS.fullmatch(page.partition("://")[2].split("#", 1)[0]).groups()
        folder = folder or "/"
        path, mark, query = link.partition("?")
        query = mark + query
        path = path if path.startswith("/") else folder[:folder.rindex("/") + 1] + path if path else folder
    return f"http://{host}{_without_dots(path) if path else path}{query}"


def _targets(pages: pa.Array, links: pa.Array) -> pa.Array:
    return pa.array([target_of(p, x) for p, x in zip(pages.to_pylist(), links.to_pylist())], pa.string())


_resolved = on_arrow(_targets, "string")


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target): the addresses that pages name as canonical or send their readers to.

    HTML entities are decoded and relative targets resolved against the page's address, as browsers do; targets
    within the page, and those on no host (``mailto:``), are no links.
    """
    u, h = F.col(f"`{url}`"), F.col(f"`{html}`")
    targets = F.concat(F.regexp_extract_all(h, F.lit(_CANONICAL), F.lit(1)), F.regexp_extract_all(h, F.lit(_REFRESH), F.lit(1)))
    found = (pages.where(u.isNotNull() & h.isNotNull()).select(u.alias("u"), targets.alias("ts"))
             .where(F.size("ts") > 0).select("u", F.explode("ts").alias("t")).where(node_of(F.col("u")).isNotNull()))
    found = found.select(node_of(F.col("u")).alias("source"), _resolved(F.col("u"), F.col("t")).alias("t"))
    return (found.withColumn("target", node_of(F.col("t"))).select("source", "target")
            .where("source is not null and target is not null"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None,
          url: str = "url", html: str = "html") -> tuple[DataFrame, str]:
    """``pages`` with one struct column (host, path, rule, verdict), and that column's name.

    A rule's verdict stands.  Where no rule fits, the verdict is ``allow`` if a rule allows an alias, else
    ``block`` if a rule blocks one, else ``allow``.  ``redirects`` holds (source, target) addresses of a crawl
    besides the links in the pages.  Null and hostless addresses have no aliases.
    """
    links = page_links(pages, url, html)
    if redirects is not None:
        links = links.unionByName(redirects.select(node_of(F.col("source")).alias("source"),
                                                   node_of(F.col("target")).alias("target")))
    aliases = written(components(links, "source", "target"), "aliases")
    host, path = host_and_path(F.concat(F.lit("x://"), F.col("node")))
    aliases = aliases.withColumn("host", host).withColumn("path", path)
    aliases = aliases.withColumn("own", rule_for(F.col("host"), F.col("path"), rules)["verdict"])
    own = F.col("own")
    of_root = aliases.groupBy("root").agg(F.max(F.coalesce(own == "allow", F.lit(False))).alias("allowed"),
                                          F.max(F.coalesce(own == "block", F.lit(False))).alias("blocked"))
    node, carried = fresh(pages, "url_node"), fresh(pages, "url_carried")
    decided = written(aliases.join(of_root, "root").where("blocked and not allowed").select(F.col("node").alias(node)),
                      "blocked-aliases").withColumn(carried, F.lit(True))
    host, path = host_and_path(F.col(f"`{url}`"))
    own_host, own_path, own_rule = (fresh(pages, c) for c in ("url_host", "url_path", "url_rule"))
    name = fresh(pages, "judged")
    # One projection after the other, so that host and path are computed once and not again for every rule.
    out = pages.withColumns({node: node_of(F.col(f"`{url}`")), own_host: host, own_path: path})
    out = out.withColumn(own_rule, rule_for(F.col(own_host), F.col(own_path), rules)).join(decided, node, "left")
    verdict = F.coalesce(F.col(own_rule)["verdict"], F.when(F.col(carried), F.lit("block")), F.lit("allow"))
    out = out.withColumn(name, F.struct(F.col(own_host).alias("host"), F.col(own_path).alias("path"),
                                        F.col(own_rule)["rule"].alias("rule"), verdict.alias("verdict")))
    return out.select(*[F.col(f"`{c}`") for c in pages.columns], F.col(f"`{name}`")), name


def url_query(spark, folder: str) -> DataFrame:
    out, name = judge(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html"))
    return out.select("page_id", f"{name}.*")
