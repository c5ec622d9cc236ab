"""URL filter: rules indexed by their rarest literal token. DataFrame
operations only.

A url's address is its host (A-Z lower-cased) followed by its path. A rule is
a pattern over the address: ``||`` at its start means the start of the host or
of one of its labels, ``*`` any run of characters; all else is literal. Every
rule is kept under the one of its whole tokens that the fewest urls have. A
url's tokens fetch its candidates, and only their regular expressions run.

Null urls, and urls without ``://``, have an empty host and path.
"""

from __future__ import annotations

import json
import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablero.llm._common import fresh, others

#: Rules travel as literals inside the plan; a longer list is applied in parts.
MOST_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """``exact`` rules come first: of those that fit the longest decides. Else
    any other blocking rule that fits blocks."""

    pattern: str
    verdict: str = "block"
    exact: bool = False

    @property
    def name(self) -> str:
        return self.pattern.removeprefix("||")

    @property
    def regex(self) -> str:
        body = ".*".join(re.escape(p).replace("/", "/") for p in self.name.split("*"))
        return ("^(?:[^/]*[.])?" if self.pattern.startswith("||") else "") + body

    @property
    def tokens(self) -> list[str]:
        """Runs of letters and digits that any fitting address has as a whole."""
        edge = "." if self.pattern.startswith("||") else "*"
        return re.findall(r"(?<![A-Za-z0-9*])[A-Za-z0-9]+(?![A-Za-z0-9*])", edge + self.name + "*")


def host_rule(verdict: str, place: str) -> Rule:
    """A rule ``host/path``: fits the host and its subdomains where the path starts with the rule's."""
    return Rule("||" + place, verdict, exact=True)


_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _ADDRESS, 1), string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _ADDRESS, 2)


def _tokens(address: Column) -> Column:
    return F.array_distinct(F.split(address, "[^A-Za-z0-9]+"))


def token_counts(addresses: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """How many rows of ``addresses`` (one column) hold each token of the rules:
    one scan for all of them; the driver receives one count per token."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if any(not r.tokens for r in rules):
        raise ValueError("a rule needs one whole literal token")
    known = F.from_json(F.lit(json.dumps(wanted)), "array<string>")
    held = addresses.select(F.explode(F.array_intersect(_tokens(F.col(addresses.columns[0])), known)).alias("t")) if len(wanted) <= MOST_RULES else (
        addresses.select(F.explode(_tokens(F.col(addresses.columns[0]))).alias("t"))
        .join(F.broadcast(addresses.sparkSession.createDataFrame([(t,) for t in wanted], "t string")), "t"))  # as many rows as the rules have tokens
    return {r.t: r["count"] for r in held.groupBy("t").count().collect()}


def index(addresses: DataFrame, rules: list[Rule], counts: dict[str, int] | None = None) -> dict[str, list[int]]:
    """Rule numbers by token: each rule under its token that the fewest rows of
    ``addresses`` (one column) have, by ``counts`` if they are known already."""
    counts = token_counts(addresses, rules) if counts is None else counts
    out: dict[str, list[int]] = {}
    for i, r in enumerate(rules):
        out.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(i)
    return out


def judge(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (of the exact rule that decides;
    else null), ``verdict`` (allow or block) and ``n_tried``, the rules whose
    expression ran. Columns called like these, in any case, are replaced; others
    travel along."""
    address = F.concat(host(F.col(url)), path(F.col(url)))
    addresses = pages.select(address.alias("address"))
    counts = token_counts(addresses, rules)
    fitting, tried = [], []
    for at in range(0, len(rules), MOST_RULES):
        part = rules[at : at + MOST_RULES]
        by_token = F.from_json(F.lit(json.dumps(index(addresses, part, counts))), "map<string,array<int>>")
        shape = "array<struct<name:string,regex:string,verdict:string,exact:boolean,size:int>>"
        table = F.from_json(F.lit(json.dumps([{"name": r.name, "regex": r.regex, "verdict": r.verdict, "exact": r.exact, "size": len(r.name)}
                                              for r in part])), shape)
        known = F.array_intersect(_tokens(address), F.map_keys(by_token))
        candidates = F.flatten(F.transform(known, lambda t: F.element_at(by_token, t)))
        tried.append(F.size(candidates))
        rows = F.transform(candidates, lambda i: F.element_at(table, i + 1))
        fitting.append(F.filter(rows, lambda r: F.regexp_like(address, r["regex"])))
    fits = F.concat(*fitting) if fitting else F.array().cast("array<struct<name:string,regex:string,verdict:string,exact:boolean,size:int>>")
    exact = F.array_max(F.transform(F.filter(fits, lambda r: r["exact"]), lambda r: F.struct(r["size"], r["name"], r["verdict"])))
    blocked = F.exists(fits, lambda r: ~r["exact"] & (r["verdict"] == "block"))
    own = others(pages.columns, "host", "path", "rule", "verdict", "n_tried")
    judged = fresh(pages.columns, "judged")
    n_tried = tried[0] if tried else F.lit(0)
    for t in tried[1:]:
        n_tried = n_tried + t
    out = pages.select(*own, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), F.struct(
        exact.alias("exact"), blocked.alias("blocked"), n_tried.alias("n")).alias(judged))
    return out.select(*own, "host", "path", F.col(f"{judged}.exact.name").alias("rule"),
                      F.coalesce(F.col(f"{judged}.exact.verdict"), F.when(F.col(f"{judged}.blocked"), "block").otherwise("allow")).alias("verdict"),
                      F.col(f"{judged}.n").cast("long").alias("n_tried"))
