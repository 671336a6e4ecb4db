"""Operator 4 — URL filters: rules indexed by their rarest literal token.

A rule is a pattern over ``host + path`` of a URL (host in lower case; the path
is empty or starts with ``/``). Pattern language: ``||`` at the start anchors the
pattern at the host or one of its parent domains, ``*`` stands for any
characters, a final ``$`` anchors the end; everything else is literal and, without
``||``, may occur anywhere.

Index: each rule's whole literal tokens (alphanumeric runs with a non-alphanumeric
literal or the host anchor on both sides) are counted over the URLs of the table,
and the rule is filed under the rarest one; rules without such a token are filed
under the empty token, which every URL asks for. A URL looks its own tokens up in
the index and only the rules found run their regular expression on it. The fit
with the highest tier, then the longest pattern, then the greatest name wins.

Everything runs as DataFrame expressions in one pass over the URL column: the
index (at most ``MAX_RULES`` rules, checked) is a literal map inside the plan, so
no URL is shuffled and a hot host costs only its own rows. The token counts are
one aggregation over the tokens that occur in rules, pre-aggregated per task.

Cases: a NULL URL or one without ``://`` has empty host and path, fits no anchored
rule and gets the default verdict; an empty path does not start with ``/``;
repeated rows are judged alike; an empty table gives an empty result; no rules
gives the default everywhere.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 5_000
TOKEN = "[0-9A-Za-z]+"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str            # "allow" or "block"
    pattern: str
    tier: int = 0           # a fit of a higher tier beats any of a lower one

    def regex(self) -> str:
        body, anchored = self.pattern, self.pattern.startswith("||")
        body = body[2:] if anchored else body
        end = body.endswith("$")
        body = body[:-1] if end else body
        parts = "[\\s\\S]*".join(re.sub(r"([!-,.:-@\[-`{-~ ])", r"\\\1", p) for p in body.split("*"))
        return ("^(?:[^/]*\\.)?" if anchored else "") + parts + ("$" if end else "")

    def tokens(self) -> list[str]:
        """Literal tokens that any fitting URL contains as whole tokens."""
        body, anchored = self.pattern, self.pattern.startswith("||")
        body = body[2:] if anchored else body
        end = body.endswith("$")
        body = body[:-1] if end else body
        # the host anchor and the end anchor delimit a token; a wildcard does not
        text = ("." if anchored else "*") + body + ("." if end else "*")
        return sorted({m[1] for m in re.finditer(rf"(?<=[^0-9A-Za-z*])({TOKEN})(?=[^0-9A-Za-z*])",
                                                 text)})


def host_rule(verdict: str, host: str, path: str) -> Rule:
    return Rule(host + path, verdict, f"||{host}{path}", 1)


#: The rules every run has, as (verdict, host, path).
BASE_RULES = tuple(host_rule(*r) for r in (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/")))
#: General patterns for what those rules leave undecided.
MORE_RULES = (
    Rule("login pages", "block", "/login/"), Rule("sign-up pages", "block", "/signup/"),
    Rule("carts", "block", "/cart/"), Rule("checkouts", "block", "/checkout/"),
    Rule("tag listings", "block", "/tag/"), Rule("search results", "block", "/search/"),
    Rule("archives", "block", ".zip$"), Rule("programs", "block", ".exe$"),
    Rule("images", "block", ".jpg$"), Rule("scripts", "block", ".js$"),
    Rule("advert hosts", "block", "||ads.*"), Rule("tracker hosts", "block", "||tracker.*"),
)
DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path as columns; empty without ``://``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return (F.coalesce(F.translate(host, upper, lower), F.lit("")),
            F.coalesce(path, F.lit("")))


def _token_column(subject: Column) -> Column:
    return F.array_distinct(F.filter(F.split(subject, "[^0-9A-Za-z]+"), lambda t: t != F.lit("")))


def build_index(urls: DataFrame, rules: tuple[Rule, ...]) -> dict[str, list[Rule]]:
    """Token → rules filed under it. ``urls`` has the column ``_subject``."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    literal = sorted({t for r in rules for t in r.tokens()})
    seen: dict[str, int] = {}
    if literal:
        # only tokens of rules are counted, so at most that many rows come back
        rows = (urls.select(F.explode(F.filter(_token_column(F.col("_subject")),
                                               lambda t: t.isin(*literal))).alias("t"))
                .groupBy("t").count().collect())
        seen = {r["t"]: r["count"] for r in rows}
    index: dict[str, list[Rule]] = {}
    for r in rules:
        rarest = min(r.tokens(), key=lambda t: (seen.get(t, 0), t), default="")
        index.setdefault(rarest, []).append(r)
    return index


def _index_column(index: dict[str, list[Rule]]) -> Column:
    def entry(r: Rule) -> Column:
        return F.struct(F.lit(r.tier).alias("tier"), F.lit(len(r.pattern.removeprefix("||"))).alias("size"),
                        F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"),
                        F.lit(r.regex()).alias("regex"))
    parts: list[Column] = []
    for token, rules in sorted(index.items()):
        parts += [F.lit(token), F.array(*[entry(r) for r in rules])]
    return F.create_map(*parts)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES,
          keep: tuple[str, ...] = ("page_id",), default: str = DEFAULT) -> DataFrame:
    """``keep``, host, path, rule (name of the winning fit or NULL), tier,
    verdict, n_candidates."""
    host, path = host_and_path(F.col("url"))
    split = pages.select(*keep, host.alias("host"), path.alias("path"))
    subject = split.select(*keep, "host", "path",
                           F.concat("host", "path").alias("_subject"))
    index = build_index(subject, rules)
    if not index:
        return subject.select(*keep, "host", "path", F.lit(None).cast("string").alias("rule"),
                              F.lit(None).cast("int").alias("tier"),
                              F.lit(default).alias("verdict"),
                              F.lit(0).cast("long").alias("n_candidates"))
    table = _index_column(index)
    known = [t for t in index if t]
    tokens = F.array_append(F.filter(_token_column(F.col("_subject")), lambda t: t.isin(*known))
                            if known else F.array().cast("array<string>"), F.lit(""))
    fetched = subject.select(
        *keep, "host", "path", "_subject",
        F.flatten(F.filter(F.transform(tokens, lambda t: F.try_element_at(table, t)),
                           lambda a: a.isNotNull())).alias("_c"))
    fits = F.filter("_c", lambda r: F.regexp(F.col("_subject"), r["regex"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(
        r["tier"].alias("tier"), r["size"].alias("size"), r["name"].alias("name"),
        r["verdict"].alias("verdict"))))
    return fetched.select(
        *keep, "host", "path", F.size("_c").cast("long").alias("n_candidates"),
        best.alias("_b")).select(
        *keep, "host", "path", F.col("_b.name").alias("rule"), F.col("_b.tier").alias("tier"),
        F.coalesce("_b.verdict", F.lit(default)).alias("verdict"), "n_candidates")
