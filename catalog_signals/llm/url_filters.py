"""URL filters: fixed rules first, else the reputation of the host.

Reputation is the share of good outcomes among a host's labelled pages, shrunk by beta-binomial priors
from the host to its registered domain, its suffix and the whole. The strength of each level's prior is
estimated from the spread of outcomes below it. A host is blocked if even the upper bound of its
posterior share is under a threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_signals.llm.text import checkpointed, straight_from_shuffle


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host, then a path from the first ``/`` on; ``verdict`` is allow or block."""

    pattern: str
    verdict: str


#: The rules of the task.
RULES = (
    Rule("org/", "allow"),
    Rule("example.org/es/", "block"),
    Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"),
    Rule("com/de/", "block"),
)

#: Labels that form a suffix together with a country's two letters.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Reputation:
    """A host is blocked if posterior mean plus ``z`` standard deviations is below ``min_good``.
    Correlations within a level are kept between ``least`` and ``1 - least``."""

    min_good: float = 0.5
    z: float = 1.645
    least: float = 0.001


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path as the contract defines them; both empty without ``://``."""
    start = F.instr(url, "://")
    after = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(after, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule that fits, null if none does."""
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: len(rule.pattern)):
        of, _, below = rule.pattern.partition("/")
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit("/" + below))
        pattern = F.when(fits, F.lit(rule.pattern)).otherwise(pattern)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return pattern, verdict


def _levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix. A host without a dot, or of digits and dots only, has no suffix
    and is its own domain; a port doesn't count."""
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    labels = F.split(bare, r"\.")
    last, second = F.element_at(labels, -1), F.get(labels, F.size(labels) - 2)
    pair = (F.length(last) == 2) & second.isin(*SECOND_LEVEL) & (F.size(labels) > 2)
    suffix = F.when(pair, F.concat_ws(".", second, last)).otherwise(last)
    owner = F.get(labels, F.size(labels) - F.when(pair, 3).otherwise(2))
    whole = (F.size(labels) < 2) | bare.rlike("^[0-9.]*$")
    return F.when(whole, bare).otherwise(F.concat_ws(".", owner, suffix)), F.when(whole, F.lit("")).otherwise(suffix)


def _prior_strength(level: DataFrame, least: float) -> float:
    """Pseudo-observations a parent's share is worth, from the spread of its children's shares.

    If outcomes below a parent of share m correlate by r, then n (k/n - m)^2 is m(1-m)(1 + (n-1) r) on
    average; r is solved from the sums over all children, and the strength is 1/r - 1.
    """
    spread = F.col("m") * (1 - F.col("m"))
    seen = level.where("n > 0").agg(
        F.sum(F.col("n") * (F.col("k") / F.col("n") - F.col("m")) ** 2).alias("s"),
        F.sum(spread).alias("v"),
        F.sum(spread * (F.col("n") - 1)).alias("w"),
    ).first()
    r = (seen.s - seen.v) / seen.w if seen.w else 1.0
    r = min(max(r, least), 1 - least)
    return 1 / r - 1


def _shrunk(strength: float) -> Column:
    return (F.col("k") + strength * F.col("m")) / (F.col("n") + strength)


def host_reputation(urls: DataFrame, outcomes: DataFrame, how: Reputation) -> DataFrame:
    """``host``, ``labelled``, ``mean``, ``bound`` and ``reputation`` (allow or block) for every host.

    ``urls`` has ``page_id`` and ``host``; ``outcomes`` has ``page_id`` and ``good`` (1 or 0; null counts
    as unlabelled, several outcomes of a page all count). Without any label, hosts stand at one half.
    """
    per_page = outcomes.where("good is not null and page_id is not null").groupBy(
        F.col("page_id").alias("_id")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("double")).alias("k"))
    domain, suffix = _levels(F.col("host"))
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    labelled = urls.join(straight_from_shuffle(per_page), F.col("page_id") == F.col("_id"), "left")
    per_host = labelled.groupBy("host").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "k")]
    )
    hosts = checkpointed(per_host.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "k"))
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = hosts.groupBy("suffix").agg(*sums)
    total = suffixes.agg(*sums).first()
    share = total.k / total.n if total.n else 0.5

    suffixes = suffixes.withColumn("m", F.lit(share))
    suffixes = suffixes.select("suffix", _shrunk(_prior_strength(suffixes, how.least)).alias("m"))
    domains = domains.join(straight_from_shuffle(suffixes), "suffix")
    domains = domains.select("domain", "suffix", _shrunk(_prior_strength(domains, how.least)).alias("m"))
    hosts = hosts.join(straight_from_shuffle(domains), ["domain", "suffix"])
    strength = _prior_strength(hosts, how.least)
    mean, weight = _shrunk(strength), F.col("n") + strength
    bound = mean + how.z * F.sqrt(mean * (1 - mean) / (weight + 1))
    verdict = F.when(bound < how.min_good, "block").otherwise("allow")
    return hosts.select(
        "host", F.col("n").alias("labelled"), mean.alias("mean"), bound.alias("bound"), verdict.alias("reputation")
    )


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, how: Reputation | None = None
) -> DataFrame:
    """Per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``mean`` and ``bound``.

    Null or malformed urls have an empty host, which has a reputation like any other. Repeated rows
    and null ids stay as they are; a null id has no outcome.
    """
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    reputation = host_reputation(urls, outcomes, how or Reputation()).withColumnRenamed("host", "_host")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    joined = urls.join(straight_from_shuffle(reputation), F.col("host") == F.col("_host"))
    return joined.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.col("reputation")).alias("verdict"), "mean", "bound",
    )
