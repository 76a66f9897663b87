"""URL filter: a blocked Bloom filter of listed canonical URLs in front of an exact hash join.

A listed rule is a host and a path; its canonical URL is their concatenation. A page is judged by
the canonical URLs that could list it: each suffix of its host at a label boundary that is as long
as some listed host, followed by each prefix of its path that is as long as some listed path. These candidates are probed in the
filter, 64 bits to a block, and only possible hits take part in the join that decides. False
positives of the filter find no partner there, so they never reach the result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
BITS_PER_URL = 16
BITS_SET = 6
# The filter is broadcast: at most this many blocks of 8 bytes, however long the list is.
MAX_BLOCKS = 1 << 20


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, URL, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def listed(rules: DataFrame) -> DataFrame:
    """Canonical rules: ``_key``, ``_host``, ``_verdict``, one row per key.

    A rule without a host lists nothing. Of contradicting rules the one that blocks stays.
    """
    host = F.translate("host", string.ascii_uppercase, string.ascii_lowercase)
    return (
        rules.filter(F.length("host") > 0)
        .select(host.alias("_host"), F.coalesce("path", F.lit("")).alias("_path"), "verdict")
        .groupBy("_host", "_path", F.concat("_host", "_path").alias("_key"))
        .agg(F.max("verdict").alias("_verdict"))
    )


def _mask(key: Column) -> Column:
    digest = F.xxhash64(key)
    bits = [
        F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))
        for place in (F.shiftright(digest, 22 + 6 * i).bitwiseAND(63) for i in range(BITS_SET))
    ]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter as a table: ``_block`` and its 64 bits ``_bits``, empty blocks left out."""
    return keys.groupBy(_block(F.col("_key"), blocks).alias("_block")).agg(
        F.bit_or(_mask(F.col("_key"))).alias("_bits")
    )


def _block(key: Column, blocks: int) -> Column:
    return F.xxhash64(key).bitwiseAND(blocks - 1)


def block_count(n_rules: int, max_blocks: int = MAX_BLOCKS) -> int:
    """A power of two with ``BITS_PER_URL`` bits per listed URL, up to ``max_blocks``."""
    wanted = max(1, n_rules * BITS_PER_URL // 64)
    return min(max_blocks, 1 << (wanted - 1).bit_length())


def candidates(urls: DataFrame, hosts: list[int], paths: list[int]) -> DataFrame:
    """Every canonical URL that could list a page: ``_url``, ``_key``.

    Only suffixes and prefixes as long as some listed host and path, ``hosts`` and ``paths``, are
    cut out, so a host of very many labels costs no more than the list has lengths.
    """
    whole = F.length("_host")
    at_label = lambda n: (n == whole) | (F.substring(F.col("_host"), whole - n, F.lit(1)) == ".")
    suffixes = F.transform(
        F.filter(_lengths(hosts), lambda n: (n <= whole) & at_label(n)),
        lambda n: F.substring(F.col("_host"), whole - n + 1, n),
    )
    prefixes = F.transform(
        F.filter(_lengths(paths), lambda n: n <= F.length("_path")),
        lambda n: F.substring(F.col("_path"), F.lit(1), n),
    )
    placed = urls.select("_url", "_path", F.explode(suffixes).alias("_suffix"))
    parts = placed.select("_url", "_suffix", F.explode(prefixes).alias("_prefix"))
    return parts.select("_url", F.concat("_suffix", "_prefix").alias("_key"))


def _lengths(found: list[int]) -> Column:
    return F.array(*[F.lit(n) for n in found]).cast("array<int>")


def possible_hits(probes: DataFrame, rules: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The candidates whose bits are all set; a superset of the listed ones."""
    blocks = block_count(rules.count(), max_blocks)
    bloom = F.broadcast(bloom_blocks(rules, blocks))
    probed = probes.withColumn("_block", _block(F.col("_key"), blocks)).join(bloom, "_block")
    mask = _mask(F.col("_key"))
    return probed.filter(F.col("_bits").bitwiseAND(mask) == mask).select("_url", "_key")


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of the longest fitting rule.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains if
    the path of the URL starts with the rule's. The longest canonical rule wins, of equally long
    ones the one with the longer host. A URL that no rule fits has no ``rule`` and the verdict
    ``default``; so has a null or empty URL, or one without ``://``, whose host and path are
    empty. Repeated rows are judged alike and all kept; columns of ``pages`` named like the four
    results are replaced. Without pages or rules the result has the same columns.

    URLs are made distinct before anything is joined, so a URL of a third of all rows is probed
    once, and rows meet the verdict of their URL in a join that the planner can split.
    """
    own = listed(rules)
    hosts, paths = (
        sorted(r[0] for r in own.select(F.length(name)).distinct().collect()) for name in ("_host", "_path")
    )
    urls = pages.select(F.col(url).alias("_url")).filter(F.col("_url").isNotNull()).distinct()
    urls = urls.withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))})
    probes = candidates(urls, hosts, paths)
    hits = possible_hits(probes, own, max_blocks)
    rank = F.struct(F.length("_key"), F.length("_host"), "_key", "_verdict")
    best = hits.join(own, "_key").groupBy("_url").agg(F.max(rank).alias("_best"))
    judged = pages.join(best, pages[url] == best["_url"], "left")
    return judged.withColumns(
        {
            "host": host_of(pages[url]),
            "path": path_of(pages[url]),
            "rule": F.col("_best._key"),
            "verdict": F.coalesce("_best._verdict", F.lit(default)),
        }
    ).drop("_url", "_best")


# The rules of the query, as host, path and verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.sql(f"VALUES {', '.join(map(str, RULES))} AS rules(host, path, verdict)")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE = f"""
WITH rules(rule_host, rule_path, verdict) AS (
    VALUES {", ".join(str(r) for r in RULES)}
), placed AS (
    SELECT page_id, url, CASE WHEN strpos(coalesce(url, ''), '://') > 0
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, url,
        translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}',
            '{string.ascii_lowercase}') AS host,
        regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM placed
), ranked AS (
    SELECT p.*, r.rule_host || r.rule_path AS rule, r.verdict,
        row_number() OVER (PARTITION BY p.page_id, p.url
            ORDER BY length(r.rule_host || r.rule_path) DESC, length(r.rule_host) DESC) AS place
    FROM parts p JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT p.page_id, p.host, p.path, r.rule, coalesce(r.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN ranked r
ON p.page_id = r.page_id AND p.url = r.url AND r.place = 1
"""
