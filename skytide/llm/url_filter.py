"""URL rules indexed by their rarest literal token.

A rule is a regular expression with literal tokens that every match contains
whole. Over all urls the tokens' frequencies are counted; each rule is filed
under its rarest one. A url fetches the rules filed under its own tokens, and
only those run their expression. Rules without a literal are tried on every url,
and only those that match make a row.

Two layers: list rules ``host/path`` (a host with its subdomains, and a prefix of
the path; the longest fitting rule wins), then pattern rules on the whole url,
lower-cased in A-Z, for urls no list rule decides; a block among the matching
pattern rules wins over an allow, an exception over a block; without any match a url
is allowed. ``filter_list`` reads pattern rules in the usual notation of such lists.

Different urls are judged once. The rule index is a table like any other: Spark
broadcasts it when its size allows, else joins it by token and splits hot ones.

A null url, or one without ``://``, has empty host and path and fits no list
rule; an empty or null url is allowed. Repeated pages each get their row, with
null ids too; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytide.session import small_table, stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = "[a-z0-9]+"

LIST_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

# name, verdict, expression on the lower-cased url, literal tokens of every match
PATTERN_RULES = (
    ("spam farms", "block", r"(?<![a-z0-9])spam-farm(?![a-z0-9])", ("spam", "farm")),
    ("pill shops", "block", r"(?<![a-z0-9])cheap-(pills|meds)(?![a-z0-9])", ("cheap",)),
    ("casinos", "block", r"(?<![a-z0-9])(online-)?casino(?![a-z0-9])", ("casino",)),
    ("adult", "block", r"(?<![a-z0-9])(xxx|porn)(?![a-z0-9])", ()),
    ("addresses", "block", r"^[a-z]+://[0-9]+(\.[0-9]+){3}([:/?#]|$)", ()),
    ("tracked spam", "block", r"[?&]utm_campaign=(spam|bulk)(?![a-z0-9])", ("utm", "campaign")),
)


@dataclass(frozen=True)
class Rule:
    rule: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    listed: bool
    length: int


_RULE = ("rule", "verdict", "pattern", "listed", "length")


def list_rule(name: str, verdict: str) -> Rule:
    """``host/path``: the pattern reads host and path written together."""
    host, _, path = name.partition("/")
    whole = re.findall(_TOKEN, host.lower())
    # the path's last token may go on in the url
    inner = re.findall(_TOKEN + r"(?=[^a-z0-9])", path.lower())
    pattern = r"^([^/]*\.)?" + re.escape(host.lower()) + re.escape("/" + path)
    return Rule(name, verdict, pattern, tuple(dict.fromkeys(whole + inner)), True, len(name))


def pattern_rule(name: str, verdict: str, pattern: str, literals: tuple[str, ...], exception: bool = False) -> Rule:
    """``length`` ranks the matching ones: allow, block, exception."""
    return Rule(name, verdict, pattern, tuple(literals), False, 2 if exception else int(verdict == "block"))


# Fixed notation: ``||`` a host or its subdomains, ``|`` the url's start or end, ``^`` a
# separator or the end, ``*`` anything, ``@@`` an exception, ``/…/`` an expression.
_HOST_START = "^[a-z][a-z0-9+.-]*://([^/?#]*[.])?"
_SEPARATOR = "([^a-z0-9_.%-]|$)"


def filter_list(lines) -> list[Rule]:
    """Rules of a filter list. Comments (``!``) and headers (``[``) are left out; options
    (``$…``) say what a crawler does not know, so a line with them is an error."""
    rules = []
    for line in (raw.strip() for raw in lines):
        if not line or line.startswith(("!", "[")):
            continue
        exception, body = line.startswith("@@"), line.removeprefix("@@").translate(str.maketrans(_UPPER, _LOWER))
        verdict = "allow" if exception else "block"
        if len(body) > 2 and body.startswith("/") and body.endswith("/"):
            rules.append(pattern_rule(line, verdict, line.removeprefix("@@")[1:-1], (), exception))
            continue
        if "$" in body:
            raise ValueError(f"options are not supported: {line!r}")
        host, start, end = body.startswith("||"), body.startswith("|"), body.endswith("|") and len(body) > 1
        body = body[2 if host else int(start) : len(body) - int(end)]
        pattern = "".join({"^": _SEPARATOR, "*": ".*"}.get(c) or re.escape(c) for c in body)
        # a token is whole if on either side stands what cannot go on with it
        bounded = ("^" if start or host else "*") + body + ("^" if end else "*")
        literals = re.findall("(?<=[^a-z0-9*])" + _TOKEN + "(?=[^a-z0-9*])", bounded)
        anchored = (_HOST_START if host else "^" if start else "") + pattern + ("$" if end else "")
        rules.append(pattern_rule(line, verdict, anchored, tuple(dict.fromkeys(literals)), exception))
    return rules


def default_rules() -> list[Rule]:
    return [list_rule(*r) for r in LIST_RULES] + [pattern_rule(*r) for r in PATTERN_RULES]


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def with_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` and ``path``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    none = F.lit("")
    return pages.withColumn("path", F.when(at > 0, path).otherwise(none)).withColumn("host", F.when(at > 0, lowered(host)).otherwise(none))


def rule_index(spark: SparkSession, rules: list[Rule], tokens: DataFrame) -> DataFrame:
    """Rules that have literals, with the ``token`` they are filed under: the literal rarest in ``tokens``."""
    schema = "rule string, verdict string, pattern string, listed boolean, length int, literals array<string>"
    rows = [{c: getattr(r, c) for c in _RULE} | {"literals": list(r.literals)} for r in rules]
    table = small_table(spark, rows, schema)
    literals = table.select("rule", "pattern", F.explode("literals").alias("token"))
    counted = tokens.join(literals.select("token").distinct(), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        literals.join(counted, "token", "left")
        .groupBy("rule", "pattern")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    )
    return table.drop("literals").join(rarest, ["rule", "pattern"])


def judge(pages: DataFrame, rules: list[Rule] | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` and ``reason``, the rule of either layer that decided."""
    spark = pages.sparkSession
    rows = with_parts(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")))
    urls = rows.select("url", F.concat("host", "path").alias("place")).where("url is not null").distinct()
    urls = urls.withColumn("plain", lowered(F.col("url")))
    tokens = urls.select("*", F.explode(F.array_distinct(F.regexp_extract_all("plain", F.lit(_TOKEN), 0))).alias("token"))
    rules = default_rules() if rules is None else rules
    index = stage(rule_index(spark, [r for r in rules if r.literals], tokens.select("token")), "rules")
    filed = tokens.join(index, "token").drop("token")
    free = [r for r in rules if not r.literals]
    if free:
        # a fixed pattern each, compiled once
        each = [F.when(F.col("place" if r.listed else "plain").rlike(r.pattern), F.struct(*[F.lit(getattr(r, c)).alias(c) for c in _RULE])) for r in free]
        fitting = F.array_compact(F.array(*each))
        filed = filed.unionByName(urls.select("*", F.explode(fitting).alias("each")).select("url", "place", "plain", "each.*"))
    found = (
        filed.where("rlike(if(listed, place, plain), pattern)")
        .groupBy("url")
        .agg(F.max(F.struct("listed", "length", "rule", "verdict")).alias("best"))
        .select("url", F.col("best.listed").alias("listed"), F.col("best.rule").alias("reason"), F.col("best.verdict").alias("verdict"))
    )
    return rows.join(found, "url", "left").select(
        "page_id", "host", "path", F.when(F.col("listed"), F.col("reason")).alias("rule"),
        F.coalesce("verdict", F.lit("allow")).alias("verdict"), "reason",
    )

