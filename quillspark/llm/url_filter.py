"""URL filter: pattern rules indexed by their rarest literal token, in DataFrame operations only.

A rule is a regular expression with the literal tokens that any URL it matches
must hold, each bounded on both sides (a token is a run of a-z and 0-9 in the
lower-cased URL); both are derived from the rule's own notation.  Every rule is
filed under that token of its own which the URLs hold least often.  The distinct
URLs' tokens fetch the rules filed under them, only those rules' expressions run,
and of those that match the one with the highest rank decides.

The index is broadcast only below ``BROADCAST_BYTES``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import kept, named, refuse_clashes, stored

#: Bytes of rules (names, expressions, tokens) that are broadcast at most.
BROADCAST_BYTES = 16 << 20
#: Parts that the URLs are dealt into for rules without tokens, where those aren't broadcast.
SALTS = 64
TOKEN = "[a-z0-9]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str  # regular expression, searched in host + path (host in lower case)
    tokens: tuple[str, ...]  # bounded literals of the pattern; empty: the rule is tried on every URL
    action: str  # allow or block
    rank: int  # the highest decides, then the name
    folded: bool = False  # searched in the lower-cased host + path


def _literal(text: str) -> str:
    return "".join(f"\\{c}" if c in ".^$*+?()[]{}|\\/-" else c for c in text)


def prefix_rule(host: str, path: str, action: str) -> Rule:
    """A rule for a host with its subdomains and paths that start with ``path``; a longer one ranks higher."""
    name = host + path
    tokens = re.findall(TOKEN, host)
    inner = re.findall(TOKEN + "(?=[^a-z0-9])", path)  # the last token may go on in the URL
    return Rule(name, f"^([^/]*\\.)?{_literal(name)}", tuple(dict.fromkeys(tokens + inner)), action, len(name))


def pattern_rule(text: str, action: str = "block") -> Rule:
    """A rule for the lower-cased host + path, in a filter-list notation.

    ``||`` in front: at the host's start or behind one of its dots; ``|`` in front or
    at the end: there; ``^``: anything but a letter a-z or digit, or either end; ``*``:
    anything.  Else the text may lie anywhere.  A run of letters and digits is a token
    of the rule if what is beside it is neither ``*`` nor an open end.
    """
    if text != text.lower():
        raise ValueError("patterns are written in lower case")
    core, front, back = text, "", ""
    for mark, expression in (("||", "^(?:[^/]*\\.)?"), ("|", "^")):
        if core.startswith(mark):
            core, front = core[len(mark) :], expression
            break
    if core.endswith("|"):
        core, back = core[:-1], "\\z"
    parts = re.findall(r"\*|\^|[a-z0-9]+|[^a-z0-9*^]+", core)
    tokens = []
    for i, part in enumerate(parts):
        before = parts[i - 1] if i else ("^" if front else "*")
        after = parts[i + 1] if i + 1 < len(parts) else ("^" if back else "*")
        if re.fullmatch(TOKEN, part) and "*" not in (before, after):
            tokens.append(part)
    expressions = {"*": "(?s:.*)", "^": "(?:[^a-z0-9]|\\z)"}
    body = [expressions.get(p) or _literal(p) for p in parts]
    if parts and parts[0] == "^" and not front:
        body[0] = "(?:^|[^a-z0-9])"
    return Rule(f"pattern:{text}", front + "".join(body) + back, tuple(dict.fromkeys(tokens)), action, 0, True)


#: The prefix rules of the query, in the order given.
PREFIX_RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)

#: The method's own patterns, for URLs that no prefix rule fits: advertising, trackers, adult, gambling and spam hosts, sessions and carts, files that aren't pages.
PATTERN_RULES = tuple(
    pattern_rule(text)
    for text in (
        "||ads.", "||adserver.", "||doubleclick.net^", "^ads^banner^", "^ads^click^", "^banner^*.gif|", "^tracker^pixel^", "^popunder^",
        "^adult^x^", "^adult^video^", "^porn^", "^xxx^", "^escort^", "^casino^", "^poker^online^", "^sports^betting^", "^spam^farm^", "^link^farm^",
        "^torrent^download^", "^warez^", "/user/login^", "/account/login^", "^login|", "^signin^", "^sign^in|", "^cart^add^", "/checkout^", "^wp^login.php|", "^cgi^bin^*^search^",
        ".exe|", ".apk|", ".zip|", ".tar.gz|",
    )
)


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # or the end, A-Z lower-cased; empty for null and where there is no ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ? # or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([(i, r.name, r.pattern, list(r.tokens), r.action, r.rank, r.folded) for i, r in enumerate(rules)], "rule_no int, rule string, pattern string, tokens array<string>, action string, rank int, folded boolean")


def judge_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", keep: list[str] | None = None, default: str = "allow", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per row: the columns ``keep``, host, path, rule (null if none matched) and verdict.

    ``rules`` has the columns of ``rule_table``.  A null URL or one without ``://``
    has an empty host and path and gets ``default``, unless a rule without tokens
    matches the empty string.  URLs of any length are judged whole.  Of rules of one
    rank the last by name decides.  Repeated rows each get their row; equal URLs are
    judged once.  Columns that aren't in ``keep`` may have any name; one of ``keep``
    that is named like an output is an error.  Empty tables: no rows, or the default
    for all.
    """
    keep = [] if keep is None else keep
    refuse_clashes(keep, "host", "path", "rule", "verdict")
    url = df[url_col].cast("string")
    rows = df.select(*kept(df, keep), host_of(url).alias("host"), path_of(url).alias("path"))
    size = rules.agg(F.sum(F.octet_length("rule") + F.octet_length("pattern") + F.octet_length(F.array_join("tokens", " "))).alias("bytes"), F.count_if(F.size("tokens") == 0).alias("tokenless")).first()
    few = (size["bytes"] or 0) <= broadcast_bytes
    small = F.broadcast if few else (lambda x: x)
    places = rows.select(F.col("host").alias("h"), F.col("path").alias("p")).distinct()
    place = F.concat("h", "p")
    tokens = F.array_distinct(F.regexp_extract_all(_lowered(place), F.lit(TOKEN), F.lit(0)))
    if size["tokenless"]:
        # A token that no URL holds stands for "any URL"; where rules aren't broadcast it is dealt out by the URL's hash.
        salt = F.lit("*") if few else F.concat(F.lit("*"), F.pmod(F.xxhash64("h", "p"), F.lit(SALTS)).cast("string"))
        tokens = F.concat(F.array(salt), tokens)
    places = stored(places.select("h", "p", F.explode(tokens).alias("token")), "tokens")
    anywhere = F.array(*([F.lit("*")] if few else [F.lit(f"*{k}") for k in range(SALTS)]))
    literals = rules.where(F.size("tokens") > 0).select("rule_no", F.explode("tokens").alias("token"))
    uses = places.join(small(literals.select("token").distinct()), "token", "left_semi").groupBy("token").agg(F.count("*").alias("uses"))
    rarest = literals.join(uses, "token", "left").groupBy("rule_no").agg(F.min(F.struct(F.coalesce("uses", F.lit(0).cast("long")).alias("uses"), "token")).alias("least"))
    index = rules.join(rarest, "rule_no", "left").select(F.explode(F.when(F.size("tokens") == 0, anywhere).otherwise(F.array("least.token"))).alias("token"), "rule", "pattern", "action", "rank", "folded")
    fetched = places.join(small(index), "token").where(F.regexp_like(F.when(F.col("folded"), _lowered(place)).otherwise(place), F.col("pattern")))
    best = fetched.groupBy("h", "p").agg(F.max_by(F.struct("rule", "action"), F.struct("rank", "rule")).alias("best"))
    judged = rows.join(best, (rows["host"] == best["h"]) & (rows["path"] == best["p"]), "left")
    return named(judged, keep, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    """Query: every page's URL under the prefix rules and the method's own patterns; ``matched`` names the pattern where no prefix rule fits."""
    rules = rule_table(spark, [prefix_rule(*r) for r in PREFIX_RULES] + list(PATTERN_RULES))
    out = judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules, keep=["page_id"])
    own = F.col("rule").startswith("pattern:")
    return out.select("page_id", "host", "path", F.when(~own, F.col("rule")).alias("rule"), "verdict", F.when(own, F.col("rule")).alias("matched"))


def _oracle() -> str:
    """DuckDB twin: every rule is tried on every distinct URL, prefix rules as prefixes."""
    prefix = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in PREFIX_RULES)
    patterns = ", ".join(f"('{r.name}', '{r.pattern}', '{r.action}')" for r in PATTERN_RULES)
    low = f"translate({{}}, '{_UPPER}', '{_LOWER}')"
    return f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, {low.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(h, p, a) AS (VALUES {prefix}),
m AS (SELECT hp.host, hp.path, arg_max(r.h || r.p, length(r.h || r.p)) AS rule, arg_max(r.a, length(r.h || r.p)) AS action
      FROM (SELECT DISTINCT host, path FROM hp) hp JOIN r ON (hp.host = r.h OR ends_with(hp.host, '.' || r.h)) AND starts_with(hp.path, r.p) GROUP BY ALL),
t(name, pattern, action) AS (VALUES {patterns}),
g AS (SELECT hp.host, hp.path, max(name) AS pattern, arg_max(t.action, name) AS action FROM (SELECT DISTINCT host, path FROM hp) hp
      JOIN t ON regexp_matches({low.format("hp.host || hp.path")}, t.pattern) GROUP BY ALL)
SELECT hp.page_id, hp.host, hp.path, m.rule, coalesce(m.action, g.action, 'allow') AS verdict,
       CASE WHEN m.rule IS NULL THEN g.pattern END AS matched
FROM hp LEFT JOIN m USING (host, path) LEFT JOIN g USING (host, path)
"""


OP2_SQL = _oracle()
