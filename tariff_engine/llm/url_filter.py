"""URL filter: host and path rules, and gradient-boosted trees on lexical features for URLs without a rule.

The URLs that a rule decides are the labelled ones. The trees learn on the driver from a bounded sample of them;
suffix statistics (how often URLs with a host ending or a first path segment are blocked) are counted over all
labelled rows, in hashed buckets of a fixed number, so that neither the counts nor what is sent around grows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariff_engine.llm.boosting import BoostedTrees
from tariff_engine.llm.columns import ascii_lower, hashed_share

#: Bound of the training sample: labelled URLs, all of them or about this many by hash.
SAMPLE_URLS = 20_000
#: Buckets of each suffix statistic.
BUCKETS = 1024
#: Weight of the overall rate in a bucket's rate.
PRIOR = 4.0

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the benchmark query.
RULES = (
    UrlRule(BLOCK, "net", "/"),
    UrlRule(ALLOW, "example.net", "/en/"),
    UrlRule(BLOCK, "example.com", "/de/"),
    UrlRule(ALLOW, "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """A-Z lower-cased host after the first ``://``; empty for null and for URLs without it."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(after)


def path_of(url: Column) -> Column:
    """What stands between the host and the first ``?`` or ``#``; empty like the host."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """Name of the longest rule that fits, else null; of equally long ones the earlier."""
    found = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.lit(rule.name)).otherwise(found)
    return found


def _buckets(host: Column, path: Column) -> Column:
    """Hashed buckets of the last host label, the last two, and the first path segment."""
    keys = (
        F.substring_index(host, ".", -1), F.substring_index(host, ".", -2),
        F.regexp_extract(path, r"^/([^/]*)", 1),
    )
    return F.array(*[(F.pmod(F.xxhash64(F.lit(k), key), F.lit(BUCKETS)) + k * BUCKETS).cast("int") for k, key in enumerate(keys)])


def lexical(url: str | None, host: str, path: str) -> tuple[float, ...]:
    """Length, host length, depth, labels, digits, entropy, parameters, hyphens and odd characters of a URL."""
    url = url or ""
    n = max(1, len(url))
    counts = Counter(url)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    query = url.partition("?")[2].partition("#")[0]
    segments = [s for s in path.split("/") if s]
    return (
        len(url), len(host), len(segments), host.count(".") + 1, sum(map(str.isdigit, url)) / n,
        sum(map(str.isdigit, host)), entropy, len([q for q in query.split("&") if q]), len(query), host.count("-"),
        sum(not c.isalnum() for c in url) / n, max(map(len, segments), default=0), float("#" in url),
        len(path.rpartition(".")[2]) if "." in path else 0, float(url[:5].lower() == "https"),
    )


class UrlModel:
    """Trees with the bucket counts they were trained on."""

    def __init__(self, trees: BoostedTrees, n: np.ndarray, blocked: np.ndarray) -> None:
        self.trees, self.n, self.blocked = trees, n, blocked
        self.rate = (blocked.sum() + 0.5) / (n.sum() + 1)

    def features(self, urls: list, hosts: list, paths: list, buckets: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """``own``: labels of the rows themselves, which their statistics then leave out."""
        n, blocked = self.n[buckets], self.blocked[buckets]
        if own is not None:
            n, blocked = n - 1, blocked - own[:, None]
        rates = (blocked + PRIOR * self.rate) / (n + PRIOR)
        words = np.asarray([lexical(*row) for row in zip(urls, hosts, paths)], dtype=np.float64)
        return np.hstack([words, rates, np.log1p(n)])

    @classmethod
    def fit(cls, labelled: DataFrame, sample_urls: int = SAMPLE_URLS) -> UrlModel:
        """``labelled``: url, host, path, buckets, blocked (0 or 1)."""
        counted = labelled.select(F.explode("buckets").alias("bucket"), "blocked").groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("blocked")
        )
        n, blocked = np.zeros(3 * BUCKETS), np.zeros(3 * BUCKETS)
        for row in counted.collect():  # at most 3 * BUCKETS rows
            n[row["bucket"]], blocked[row["bucket"]] = row["n"], row["blocked"]
        model = cls(BoostedTrees(), n, blocked)
        share = sample_urls / max(1.0, n[:BUCKETS].sum())
        rows = labelled.where(hashed_share(share, "url", "key")).collect()
        rows.sort(key=lambda r: (r["url"], str(r["key"])))
        if rows:
            y = np.asarray([r["blocked"] for r in rows], dtype=np.float64)
            at = np.asarray([r["buckets"] for r in rows])
            x = model.features([r["url"] for r in rows], [r["host"] for r in rows], [r["path"] for r in rows], at, y)
            model.trees.fit(x, y)
        else:
            model.trees.base = -20.0  # nothing to learn from: allow
        return model

    def score(self, urls: list, hosts: list, paths: list, buckets: np.ndarray) -> np.ndarray:
        return self.trees.probability(self.features(urls, hosts, paths, buckets))


def filter_urls(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[UrlRule, ...] = RULES, sample_urls: int = SAMPLE_URLS
) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, score (the trees' probability of block).

    The longest fitting rule decides; without one, the trees do (block from 0.5). Null URLs and URLs without
    ``://`` have an empty host and path and no rule, so the trees judge them. Without any labelled URL all
    others are allowed. Null ids, repeated rows, extra columns and very long URLs pass; an empty table gives
    no rows.
    """
    host, path = F.col("host"), F.col("path")
    parsed = df.select(
        F.col(f"`{id_col}`").alias("key"), F.col(f"`{url_col}`").alias("url"),
        host_of(F.col(f"`{url_col}`")).alias("host"), path_of(F.col(f"`{url_col}`")).alias("path"),
    ).select("*", matching_rule(host, path, rules).alias("rule"), _buckets(host, path).alias("buckets"))
    verdicts = F.lit(None).cast("string")
    for rule in rules:
        verdicts = F.when(F.col("rule") == rule.name, F.lit(rule.verdict)).otherwise(verdicts)
    labelled = parsed.where(F.col("rule").isNotNull()).withColumn("blocked", (verdicts == BLOCK).cast("int"))
    model = UrlModel.fit(labelled, sample_urls)
    kind = parsed.schema["key"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                urls, hosts, paths = (batch.column(k).to_pylist() for k in (1, 2, 3))
                buckets = batch.column(5).flatten().to_numpy().reshape(batch.num_rows, 3)
                scores = pa.array(model.score(urls, hosts, paths, buckets))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:1], *batch.columns[2:5], scores], names=["key", "host", "path", "rule", "score"]
                )

    judged = parsed.mapInArrow(judge, f"key {kind}, host string, path string, rule string, score double")
    own = F.when(F.col("score") >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return judged.select(
        F.col("key").alias("page_id"), "host", "path", "rule", F.coalesce(verdicts, own).alias("verdict"), "score"
    )
