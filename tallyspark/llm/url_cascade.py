"""URL filter: host rules, then a Bloom filter cascade over the host universe.

Level 0 holds the listed hosts; level 1 the unlisted hosts that level 0 takes
for listed; level 2 the listed hosts that level 1 takes for those; and so on
until no error is left over the complete universe of hosts.  A host is listed
when the first level that rejects it is odd, which is exact for every host of
the universe and needs no join.  Each level is a bit array built by DataFrame
aggregation (bit_or per word), sized from the number of its keys.

The bit arrays enter the plan as literals, so their size is bounded: beyond
``MAX_BITS`` in a level the listed hosts are joined instead.

Rows: a null url or one without ``://`` has empty host and path, fits no rule
and is never listed, so it is allowed.  Repeated rows give one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import Stages, ascii_lower

# The rules of the contract (rule, host, path, verdict).
RULES = (
    ("org/", "org", "/", "allow"),
    ("example.org/es/", "example.org", "/es/", "block"),
    ("example.org/en/1", "example.org", "/en/1", "block"),
    ("com/fr/", "com", "/fr/", "allow"),
    ("com/de/", "com", "/de/", "block"),
)

# Host labels that put a host on the block list.
LISTED_HOSTS = "(^|[.-])(casino|spam|pills|bets|adult|ads)([.-]|$)"

HASHES = 4
BITS_PER_KEY = 12
MAX_BITS = 1 << 23


def split_url(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def positions(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def build_level(keys: DataFrame, level: int, bits: int) -> list[int]:
    """The words of one Bloom filter (at most ``MAX_BITS`` bits)."""
    at = keys.select(F.explode(F.array(*positions(F.col("host"), level, bits))).alias("p"))
    words = at.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
    out = [0] * (bits // 64)
    for row in words.toLocalIterator():
        out[row["w"]] = row["b"]
    return out


def holds(key: Column, level: int, words: list[int]) -> Column:
    """Bloom membership: the words are one binary literal, a byte a probe."""
    raw = b"".join((w & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "little") for w in words)
    lit, found = F.lit(raw), F.lit(True)
    for p in positions(key, level, len(words) * 64):
        byte = F.conv(F.hex(F.substring(lit, F.shiftright(p, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        found = found & (F.getbit(byte, (p % 8).cast("int")) == 1)
    return found


def build_cascade(universe: DataFrame, stages: Stages) -> list[list[int]] | None:
    """Levels over ``universe`` (host, listed); None where a level would pass
    ``MAX_BITS``."""
    left = stages.write(universe, "universe")
    levels: list[list[int]] = []
    while True:
        wanted = len(levels) % 2 == 0
        keys = left.filter(F.col("listed") == F.lit(wanted))
        n = keys.count()
        if n == 0:
            return levels
        bits = max(256, 1 << (n * BITS_PER_KEY - 1).bit_length())
        if bits > MAX_BITS:
            return None
        words = build_level(keys, len(levels), bits)
        # The keys of this level go on as the next level's other side, beside
        # those of the other side that it holds by error.
        left = stages.write(
            left.filter((F.col("listed") == F.lit(wanted)) | holds(F.col("host"), len(levels), words)),
            f"left-{len(levels)}",
        )
        levels.append(words)


def listed_by(key: Column, levels: list[list[int]]) -> Column:
    """First rejecting level odd: listed.  No level rejects: the last decides."""
    out = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        out = F.when(~holds(key, i, levels[i]), F.lit(i % 2 == 1)).otherwise(out)
    return out


def judge_urls(pages: DataFrame, listed: str = LISTED_HOSTS, rules=RULES, stages: Stages | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, listed per row of ``pages``."""
    stages = stages or Stages(pages.sparkSession, "url_cascade")
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    universe = rows.select("host").distinct().withColumn("listed", F.col("host").rlike(listed))
    levels = build_cascade(universe, stages)
    if levels is None:
        names = universe.filter("listed").select("host", F.lit(True).alias("listed"))
        rows = rows.join(names, "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    else:
        rows = rows.withColumn("listed", listed_by(F.col("host"), levels))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "listed"
    )


ORACLE = rf"""
WITH cut AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
rules(rule, rule_host, rule_path, says) AS (VALUES
  {", ".join(f"('{a}', '{b}', '{c}', '{d}')" for a, b, c, d in RULES)}),
fits AS (
  SELECT p.page_id, p.host, p.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.says, length(r.rule)) AS says
  FROM (SELECT DISTINCT page_id, host, path FROM parts) p JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
  GROUP BY p.page_id, p.host, p.path)
SELECT p.page_id, p.host, p.path, f.rule,
       coalesce(f.says, CASE WHEN regexp_matches(p.host, '{LISTED_HOSTS}') THEN 'block' ELSE 'allow' END) AS verdict,
       regexp_matches(p.host, '{LISTED_HOSTS}') AS listed
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.host = p.host AND f.path = p.path
"""
