"""URL verdicts by pattern rules that are found through their rarest literal token."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm.tables import unused

BROADCAST_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
AFTER_SCHEME = "(?s)^.*?://([^/?#]*)([^?#]*)"
WHOLE = "(?s)^.*?://(.*)$"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in ``subject``: "page" (host and path) or "whole" (all after the scheme, lower-cased).

    ``literals`` are tokens (runs of a-z and 0-9) that every fitting URL holds
    as whole tokens, in lower case; a rule without any is tried on every URL.
    """

    name: str
    verdict: str
    subject: str
    pattern: str
    literals: tuple[str, ...]


def _runs(text: str) -> list[str]:
    return "".join(c if c in LOWER or c in "0123456789" else " " for c in text.translate(str.maketrans(UPPER, LOWER))).split()


def _escaped(text: str) -> str:
    return "".join(c if c.isalnum() or c in "/-_" else f"\\{c}" for c in text)


def page_rule(name: str, verdict: str) -> Rule:
    """A rule for a host with all its subdomains and a path prefix, as in ``example.org/es/``."""
    host, _, rest = name.partition("/")
    path = "/" + rest
    whole_tokens = _runs(host) + (_runs(path) if not path[-1].isalnum() else _runs(path)[:-1])
    return Rule(name, verdict, "page", rf"^(?:[^/]*\.)?{_escaped(host)}{_escaped(path)}", tuple(dict.fromkeys(whole_tokens)))


def word_rule(word: str) -> Rule:
    """Block a URL that holds ``word`` as whole tokens."""
    return Rule(f"word {word}", "block", "whole", rf"(?:^|[^a-z0-9]){_escaped(word)}(?:[^a-z0-9]|$)", tuple(dict.fromkeys(_runs(word))))


PAGE_RULES = (
    page_rule("org/", "allow"),
    page_rule("example.org/es/", "block"),
    page_rule("example.org/en/1", "block"),
    page_rule("com/fr/", "allow"),
    page_rule("com/de/", "block"),
)
PATTERN_RULES = (
    *[word_rule(w) for w in ("porn", "xxx", "casino", "viagra", "wp-admin", "wp-login", "wp-json", "cgi-bin", "phpmyadmin", "xmlrpc")],
    Rule("tracking copy", "block", "whole", r"[?&]utm_source=", ("utm", "source")),
    Rule("session copy", "block", "whole", r"[?&](?:php)?sess(?:ion)?_?id=[0-9a-f]{8}", ()),
    Rule("later page", "block", "whole", r"[?&]page=(?:[2-9]|[1-9][0-9]+)(?:[&#]|$)", ("page",)),
    Rule("calendar trap", "block", "whole", r"/calendar/[0-9]{4}/[0-9]{1,2}/", ("calendar",)),
)


def rule_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """Rules as a table (name, verdict, subject, pattern, literals)."""
    rows = [
        F.struct(
            *[F.lit(getattr(r, c)).alias(c) for c in ("name", "verdict", "subject", "pattern")],
            F.array(*[F.lit(t) for t in r.literals]).cast("array<string>").alias("literals"),
        )
        for r in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), AFTER_SCHEME, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), AFTER_SCHEME, 2)


def _few(table: DataFrame, *texts: str) -> DataFrame:
    """Mark a table for broadcast if its measured bytes allow it; else it is joined by shuffle."""
    size = table.agg(F.sum(sum((F.octet_length(t) for t in texts), F.lit(64)))).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """All rows and columns of pages (url) with host, path, rule, pattern and verdict.

    ``rule`` is the longest page rule that fits and ``pattern`` the first
    pattern rule by name; the verdict is that of ``rule``, else of ``pattern``, else
    ``default``. A null url, or one without ``://``, has an empty host and path,
    and no rule fits it. Repeated rows stay. Input columns with the names of the
    new ones are replaced; others, whatever their names, stay. Without rules everything gets the default.

    A rule is listed under its literal token that the fewest URLs hold, counted
    over all URLs. The tokens of the distinct URLs fetch candidates, only those
    are matched, and the verdicts go back to the rows by url.
    """
    url = F.col("url").cast("string")
    pages = pages.drop("host", "path", "rule", "pattern", "verdict")
    at, by_rule, by_pattern = (unused(pages, name) for name in ("judged_url", "judged_rule", "judged_pattern"))
    urls = pages.select(url.alias("url")).where("url is not null").distinct()
    whole = F.translate(F.regexp_extract("url", WHOLE, 1), UPPER, LOWER)
    parsed = urls.select(
        "url", F.concat(host_of(F.col("url")), path_of(F.col("url"))).alias("page"), whole.alias("whole")
    ).where("whole != ''")
    # The empty token fetches the rules that have no literal.
    tokens = parsed.select("url", "page", F.col("whole").alias("all"), F.explode(
        F.array_union(F.array(F.lit("")), F.split("whole", "[^a-z0-9]+"))
    ).alias("token"))

    literals = rules.select(F.explode("literals").alias("token")).distinct()
    counted = tokens.join(_few(literals, "token"), "token").groupBy("token").agg(F.count(F.lit(1)).alias("held_by"))
    listed = rules.withColumn("token", F.explode_outer("literals")).join(counted, "token", "left")
    index = listed.groupBy("name", "verdict", "subject", "pattern").agg(
        F.min(F.struct(F.coalesce("held_by", F.lit(0)).alias("held_by"), F.coalesce("token", F.lit("")).alias("token")))["token"].alias("token")
    )
    candidates = tokens.join(_few(index, "name", "verdict", "subject", "pattern", "token"), "token")
    fits = candidates.where(F.expr("case when subject = 'page' then page rlike pattern else all rlike pattern end"))
    of_page, size = F.col("subject") == "page", F.length("name")
    best = fits.groupBy("url").agg(
        F.max(F.when(of_page, F.struct(size.alias("size"), "name", "verdict"))).alias(by_rule),
        F.min(F.when(~of_page, F.struct("name", "verdict"))).alias(by_pattern),
    )
    known = pages.where(url.isNotNull()).join(best.withColumnRenamed("url", at), url == F.col(at), "left").drop(at)
    nothing = F.lit(None)
    unknown = pages.where(url.isNull()).withColumns({c: nothing.cast(known.schema[c].dataType) for c in (by_rule, by_pattern)})
    return known.unionByName(unknown).withColumns({
        "host": host_of(url),
        "path": path_of(url),
        "rule": F.col(f"{by_rule}.name"),
        "pattern": F.col(f"{by_pattern}.name"),
        "verdict": F.coalesce(F.col(f"{by_rule}.verdict"), F.col(f"{by_pattern}.verdict"), F.lit(default)),
    }).drop(by_rule, by_pattern)
