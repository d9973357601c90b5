"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a filter in the usual block-list notation: ``||`` anchors at a host or one of its
subdomains, ``|`` at the start or end, ``*`` matches anything, ``^`` a separator or the end, and all
else is literal (A-Z folded).  A rule's *tokens* are its letter-digit runs that must stand
whole in any url it matches (bounded on both sides by a literal separator, ``^`` or an
anchor).  Each rule is filed under the token that is rarest in the urls at hand, counted over
all of them; rules without a token are filed under none and tried on every url.

A url's tokens fetch the rules filed under them, and only those run their regular
expressions.  The rule list is a parameter, travels to the tasks once and is looked up there in a hash
table, its expressions compiled when first fetched; a url costs its tokens and its fetched rules,
however many rules there are.  The urls are read once for the counts and once for the verdicts,
without a shuffle of rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class HostRule:
    """Fits a host and its subdomains when the url's path starts with ``path``."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """A filter over the whole url."""

    action: str
    pattern: str


HOST_RULES = [
    HostRule(ALLOW, "org", "/"), HostRule(BLOCK, "example.org", "/es/"), HostRule(BLOCK, "example.org", "/en/1"),
    HostRule(ALLOW, "com", "/fr/"), HostRule(BLOCK, "com", "/de/"),
]
PATTERN_RULES = [
    PatternRule(BLOCK, "||spam-farm."), PatternRule(BLOCK, "||casino."), PatternRule(BLOCK, "-casino-"),
    PatternRule(BLOCK, "||porn."), PatternRule(BLOCK, "||xxx."), PatternRule(BLOCK, "/viagra^"),
    PatternRule(BLOCK, "/adserver/"), PatternRule(BLOCK, "||ads.*/click^"), PatternRule(BLOCK, "/wp-login.php"),
    PatternRule(BLOCK, "/phishing/"), PatternRule(ALLOW, "||spam-farm.*/about^"),
]

_TOKEN = re.compile("[a-z0-9]+")


def compile_pattern(pattern: str) -> tuple[str, list[str]]:
    """``(regular expression, whole tokens)`` of a filter; the expression runs on the folded url."""
    body, regex, left = pattern.lower(), "", "\x00"
    if body.startswith("||"):
        body, regex, left = body[2:], r"^[^:/?#]*://(?:[^/?#]*\.)?", "."
    elif body.startswith("|"):
        body, regex, left = body[1:], "^", "."
    right, tail = "\x00", ""
    if body.endswith("|"):
        body, tail, right = body[:-1], r"\Z", "."
    for c in body:
        regex += ".*" if c == "*" else r"(?:[^a-z0-9_.%-]|\Z)" if c == "^" else re.escape(c)
    framed = left + body + right  # \x00 marks an open end: a token there may go on in the url
    tokens = [m.group() for m in _TOKEN.finditer(framed)
              if framed[m.start() - 1] not in "\x00*" and framed[m.end()] not in "\x00*"]
    return "(?s)" + regex + tail, tokens


def compile_host(rule: HostRule) -> tuple[str, list[str]]:
    """The same for a host rule; its expression runs on host + path."""
    framed = "." + rule.host + rule.path + "\x00"
    tokens = [m.group() for m in _TOKEN.finditer(framed.lower()) if framed[m.end()] != "\x00"]
    if rule.path != rule.path.lower():  # paths keep their case, tokens are folded
        tokens = [t for t in tokens if t in _TOKEN.findall(rule.host)]
    return r"(?s)^(?:[^/]*\.)?" + re.escape(rule.host) + re.escape(rule.path), tokens


def folded(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return folded(F.regexp_extract(url, parts, 1)), F.regexp_extract(url, parts, 2)


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(folded(F.coalesce(url, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)))


def rarest_tokens(pages: DataFrame, tokens: set[str]) -> dict[str, int]:
    """How many urls hold each of the rules' tokens (at most as many numbers as tokens)."""
    each = pages.select(F.explode(_tokens(F.col("url"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    wanted = pages.sparkSession.createDataFrame([(t,) for t in sorted(tokens)], "token string")
    return {r["token"]: r["n"] for r in each.join(wanted, "token", "left_semi").collect()}


@dataclass
class Filed:
    """A rule in the index; its expression is compiled when a url first fetches it."""

    kind: str
    action: str
    name: str
    regex: str
    fits: Callable | None = field(default=None, repr=False)

    def __call__(self, target: str, folded_url: str) -> bool:
        if self.fits is None:
            self.fits = re.compile(self.regex).search
        return self.fits(target if self.kind == "host" else folded_url) is not None


def rule_index(pages: DataFrame, host_rules: list[HostRule], pattern_rules: list[PatternRule]) -> dict[str, list[Filed]]:
    """token -> rules filed under it (``""``: rules without a token)."""
    compiled = [(compile_host(r), ("host", r.action, r.name)) for r in host_rules]
    compiled += [(compile_pattern(r.pattern), ("pattern", r.action, r.pattern)) for r in pattern_rules]
    wanted = {t for (_, tokens), _ in compiled for t in tokens}
    counts = rarest_tokens(pages, wanted) if wanted else {}
    index: dict[str, list[Filed]] = {}
    for (regex, tokens), rule in compiled:
        key = min(tokens, key=lambda t: (counts.get(t, 0), t)) if tokens else ""
        index.setdefault(key, []).append(Filed(*rule, regex))
    return index


def candidates(index: dict[str, list[Filed]], folded_url: str) -> list[Filed]:
    """The rules that a url's tokens fetch, and those filed under no token."""
    found = list(index.get("", ()))
    for token in set(_TOKEN.findall(folded_url)):
        found += index.get(token, ())
    return found


def verdict(index: dict[str, list[Filed]], target: str, folded_url: str) -> tuple[str | None, str | None, str]:
    """``(host rule, pattern rule, verdict)`` of one url."""
    host = pattern = None
    for r in candidates(index, folded_url):
        if not r(target, folded_url):
            continue
        if r.kind == "host":  # the longest, then the smaller name
            host = min(host or r, r, key=lambda x: (-len(x.name), x.name, x.action))
        else:  # the longest, then an allowing one, then the smaller name
            pattern = min(pattern or r, r, key=lambda x: (-len(x.name), x.action, x.name))
    deciding = host or pattern
    return host and host.name, pattern and pattern.name, deciding.action if deciding else ALLOW


def _judge(index: dict[str, list[Filed]]):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [verdict(index, target.as_py(), low.as_py())
                     for target, low in zip(batch.column("target"), batch.column("folded"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("page_id", "host", "path")]
                + [pa.array([f[i] for f in found], pa.string()) for i in range(3)],
                ["page_id", "host", "path", "rule", "pattern", "verdict"])

    return judge


def judge_urls(pages: DataFrame, host_rules: list[HostRule] = HOST_RULES,
               pattern_rules: list[PatternRule] = PATTERN_RULES) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, pattern, verdict``.

    ``rule`` is the longest fitting host rule (ties: the smaller name) and decides alone.  Without one, the
    longest matching pattern rule decides (an allowing one wins a tie), and a url that none
    matches is allowed.  Null urls and urls without ``://`` have an empty host and path and
    are judged by the pattern rules on what there is.  Repeated rows give repeated results; an
    empty table gives an empty one.  Only ``page_id`` and ``url`` are read.
    """
    given = pages.select("page_id", "url")
    index = rule_index(given, host_rules, pattern_rules)
    host, path = host_and_path(F.col("url"))
    rows = given.select("page_id", host.alias("host"), path.alias("path"), folded(F.coalesce("url", F.lit(""))).alias("folded"))
    schema = given.select("page_id").schema.add("host", "string").add("path", "string") \
        .add("rule", "string").add("pattern", "string").add("verdict", "string")
    return rows.withColumn("target", F.concat("host", "path")).mapInArrow(_judge(index), schema)
