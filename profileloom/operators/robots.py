"""Robots rules: read once per site, then applied to every URL of that site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LINE = r"(?i)^\s*(user-agent|allow|disallow|crawl-delay|request-rate)\s*:\s*([^#]*?)\s*(?:#.*)?$"

_AGENT, _ALLOW, _DISALLOW, _OTHER, _ENDS = "u", "a", "d", "o", "e"
_KINDS = {"user-agent": _AGENT, "allow": _ALLOW, "disallow": _DISALLOW, "crawl-delay": _OTHER, "request-rate": _OTHER}
# Possessive, hence linear and without regex-engine recursion.
_GROUP = rf"(?<=\n)(?:{_AGENT}[^\n]*+\n)++(?:[{_ALLOW}{_DISALLOW}{_OTHER}][^\n]*+\n)*+"


def _decoded(path: Column) -> Column:
    """A path with its percent escapes resolved: what begins with what is then the same
    whichever of the two sides was escaped."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def parse_rules(robots_text: Column, agent: str) -> Column:
    """Ordered rules of a robots file that bind ``agent``: array of (allow, path).

    Consecutive agent lines open a group, rule lines fill it; an empty line ends it, and
    forgets agents that have no rules yet. Rules outside a group count for nobody. The
    first group naming the agent binds; without one, the first ``*`` group does. An
    empty ``Disallow`` allows everything.
    """
    wanted = agent.split("/")[0].lower()
    lines = F.split(F.coalesce(robots_text, F.lit("")), r"\r\n|\r|\n")
    # A line becomes its kind and value: agents, allowed, disallowed and other rules, the end of a group.
    kinds = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    known = F.transform(
        lines,
        lambda line: F.when(line == "", _ENDS).otherwise(
            F.concat(F.element_at(kinds, F.lower(F.regexp_extract(line, _LINE, 1))), F.regexp_extract(line, _LINE, 2))
        ),
    )
    told = F.concat(F.lit("\n"), F.array_join(F.array_compact(known), "\n"), F.lit("\n"))
    # Agent lines in a row and the rules behind them: one pass over the text finds all groups.
    groups = F.transform(
        F.regexp_extract_all(told, F.lit(_GROUP), F.lit(0)),
        lambda group: F.transform(
            F.filter(F.split(group, "\n"), lambda line: line != ""),
            lambda line: F.struct(F.left(line, F.lit(1)).alias("kind"), _decoded(F.substring(line, 2, F.length(line))).alias("value")),
        ),
    )
    agents = lambda group: F.transform(F.filter(group, lambda x: x["kind"] == _AGENT), lambda x: F.lower(x["value"]))
    filled = F.transform(
        F.filter(groups, lambda group: F.exists(group, lambda x: x["kind"] != _AGENT)),
        lambda group: F.struct(
            F.array_contains(agents(group), "*").alias("general"),
            F.exists(agents(group), lambda a: F.lit(wanted).contains(a)).alias("own"),
            F.transform(
                F.filter(group, lambda x: x["kind"].isin(_ALLOW, _DISALLOW)),
                lambda x: F.struct(((x["kind"] == _ALLOW) | (x["value"] == "")).alias("allow"), x["value"].alias("path")),
            ).alias("rules"),
        ),
    )

    def bind(found: Column) -> Column:
        # A group that also names everybody is the general one, and no other.
        special = F.filter(found, lambda g: g["own"] & ~g["general"])
        general = F.filter(found, lambda g: g["general"])
        none = F.array().cast("array<struct<allow:boolean,path:string>>")
        return F.coalesce(F.get(special, F.lit(0))["rules"], F.get(general, F.lit(0))["rules"], none)

    return F.get(F.transform(F.array(filled), bind), F.lit(0))


def url_allowed(rules: Column, url: Column) -> Column:
    """Decision of the first rule, in file order, whose path begins the URL's path."""
    target = F.regexp_replace(url, r"(?s)^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//[^/?#]*|#.*$", "")
    path = _decoded(F.when(target == "", "/").otherwise(target))
    hits = F.filter(rules, lambda rule: F.startswith(path, rule["path"]))
    return F.coalesce(F.get(hits, F.lit(0))["allow"], F.lit(True))


def apply_robots(urls: DataFrame, robots: DataFrame, agent: str) -> DataFrame:
    """Adds ``allowed`` to ``urls(site, url, ...)`` from ``robots(site, robots_text)``.

    Rules stay one array per site, so each URL meets its site's rules in its
    own row: no URL-by-rule pairs and nothing to group again. A site without a
    robots file allows everything.
    """
    rules = robots.select("site", parse_rules(F.col("robots_text"), agent).alias("_rules"))
    joined = urls.join(rules, "site", "left")
    return joined.withColumn("allowed", url_allowed(F.col("_rules"), F.col("url"))).drop("_rules")
