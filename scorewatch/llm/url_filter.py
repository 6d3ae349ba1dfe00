"""URL filter over a sorted digest array.

A rule is a host and a path prefix; it fits its host and all subdomains if the
url's path starts with the rule's path. The index file holds the rules' 64-bit
xxhash digests in ascending order, the verdicts, and the full rule strings.
Tasks map the file into memory, hash every host suffix with every path prefix
length that rules have, probe the array by vectorised binary search, and
compare the stored string, so a digest collision never decides. The longest
rule string wins; at equal length the longer host, and block over allow for the same
rule.

The index is a stated list and goes to the executors as a file when it is no
larger than ``max_bytes``; a larger list is joined to the urls' probes by
Spark instead, with the same result.

Defined cases: a null url or one without ``://`` has an empty host and path
and gets the default verdict; repeated rows are judged each; without rules
every url gets the default; of very long urls only the endings and beginnings
that a rule could have are looked at; an empty table gives an empty table; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, sent_to_executors

BLOCK, ALLOW = "block", "allow"


def parts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host and path of each url."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + F.lit(3))).otherwise(F.lit(""))
    return pages.select(F.col(id_col).alias("page_id"),
                        ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)).alias("host"),
                        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path"))


def build(rules: list[tuple[str, str, str]]) -> bytes:
    """Index of (host, path, verdict) rules: four counts, then digests, host
    lengths, verdicts, offsets and the strings."""
    verdicts: dict[tuple[str, str], str] = {}
    for host, path, verdict in rules:
        key = (host.lower(), path)
        verdicts[key] = BLOCK if BLOCK in (verdict, verdicts.get(key)) else verdict
    rows = sorted((xxhash.xxh64_intdigest(f"{h}\n{p}"), h, p, v) for (h, p), v in verdicts.items())
    strings = [f"{h}\n{p}".encode() for _, h, p, _ in rows]
    offsets = np.cumsum([0, *map(len, strings)])
    return b"".join([np.array([len(rows), offsets[-1]], "<i8").tobytes(),
                     np.array([r[0] for r in rows], "<u8").tobytes(), offsets.astype("<i8").tobytes(),
                     np.array([r[3] == BLOCK for r in rows], np.uint8).tobytes(), *strings])


class DigestArray:
    """The index in mapped memory."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n, size = raw[:16].view("<i8").tolist()
        at = 16 + 8 * n
        self.digests = raw[16:at].view("<u8")
        self.offsets = raw[at: at + 8 * (n + 1)].view("<i8")
        at += 8 * (n + 1)
        self.block, self.strings = raw[at: at + n], raw[at + n: at + n + size]
        keys = [self.key(i).split("\n", 1) for i in range(n)]
        self.path_sizes = sorted({len(p) for _, p in keys})
        self.label_counts = sorted({h.count(".") + 1 for h, _ in keys})
        self.longest = max((len(h) for h, _ in keys), default=0)

    def key(self, i: int) -> str:
        return self.strings[self.offsets[i]: self.offsets[i + 1]].tobytes().decode()

    def find(self, keys: list[str]) -> np.ndarray:
        """Place of each key in the array, -1 if it isn't a rule."""
        found = np.full(len(keys), -1, np.int64)
        if not len(self.digests) or not keys:
            return found
        digest = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        left = np.searchsorted(self.digests, digest, "left")
        hits = np.flatnonzero(self.digests[np.minimum(left, len(self.digests) - 1)] == digest)
        for i in hits.tolist():
            at = int(left[i])
            while at < len(self.digests) and self.digests[at] == digest[i]:
                if self.key(at) == keys[i]:
                    found[i] = at
                    break
                at += 1
        return found


def probes(host: str, path: str, index: DigestArray) -> list[str]:
    """Every rule that would fit, as a key: the host's endings of as many labels
    as some rule has, no longer than the longest, with the path's beginnings of
    the rules' lengths. However long the url is, its keys are not."""
    endings, at = [], len(host)
    for count in range(1, (index.label_counts[-1] if index.label_counts else 0) + 1):
        at = host.rfind(".", 0, at)
        if count in index.label_counts and len(host) - at - 1 <= index.longest:
            endings.append(host[at + 1:])
        if at < 0 or len(host) - at > index.longest:
            break
    return [f"{ending}\n{path[:n]}" for ending in endings for n in index.path_sizes if n <= len(path)] if host else []


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW, max_bytes: int = 256 << 20,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule (the one that decided, else null), verdict.
    ``rules``: host, path, verdict."""
    spark = pages.sparkSession
    size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 80)).first()[0] or 0
    urls = parts(pages, id_col, url_col)
    if size > max_bytes:
        return judge_by_join(urls, rules, default)
    index = build([(r.host, r.path, r.verdict) for r in rules.select("host", "path", "verdict").collect()])
    return judge_by_index(urls, _published(spark, index), default)


def _published(spark: SparkSession, index: bytes) -> str:
    """The index as a file that every executor gets; returns its name there."""
    return sent_to_executors(spark, f"url-{uuid.uuid4().hex}.idx", index).rpartition("/")[2]


def judge_by_index(urls: DataFrame, name: str, default: str) -> DataFrame:
    def run(batches):
        index = DigestArray(SparkFiles.get(name))
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            keys, owner = [], []
            for i, (host, path) in enumerate(zip(hosts, paths)):
                mine = probes(host, path, index)
                keys += mine
                owner += [i] * len(mine)
            best: dict[int, tuple[int, int, str]] = {}
            found = index.find(keys)
            for at in np.flatnonzero(found >= 0).tolist():
                host = keys[at].partition("\n")[0]
                mine = (len(keys[at]), len(host), int(found[at]))
                best[owner[at]] = max(best.get(owner[at], mine), mine)
            won = [best[i][2] if i in best else None for i in range(len(hosts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"),
                 pa.array([None if w is None else index.key(w).replace("\n", "", 1) for w in won], pa.string()),
                 pa.array([default if w is None else BLOCK if index.block[w] else ALLOW for w in won], pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])

    return urls.mapInArrow(run, f"page_id {dict(urls.dtypes)['page_id']}, host string, path string, rule string, verdict string")


def judge_by_join(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same for a list of any size: probes meet the rules in an equi-join.
    Each distinct host and path is probed once."""
    rules = (rules.groupBy(F.lower("host").alias("r_host"), F.col("path").alias("r_path"))
             .agg(F.max(F.col("verdict") == BLOCK).alias("r_block")))
    sizes = [r[0] for r in rules.select(F.length("r_path")).distinct().collect()]
    pairs = urls.select("host", "path").distinct().filter("host <> ''")
    # The host's endings of as many labels as some rule has.
    counts = [r[0] for r in rules.select(F.size(F.split("r_host", "\\."))).distinct().collect()]
    dots = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit("")))
    suffix = F.array_compact(F.array(*[F.when(dots >= c - 1, F.substring_index("host", ".", -c)) for c in counts]
                                     or [F.lit(None).cast("string")]))
    probed = (pairs.withColumn("r_host", F.explode(suffix))
              .withColumn("n", F.explode(F.array(*[F.lit(n) for n in sizes] or [F.lit(0)])))
              .filter(F.col("n") <= F.length("path")).withColumn("r_path", F.expr("substring(path, 1, n)")))
    first = Window.partitionBy("host", "path").orderBy(
        F.desc(F.length("r_host") + F.length("r_path")), F.desc(F.length("r_host")))
    won = (probed.join(rules, ["r_host", "r_path"]).withColumn("nr", F.row_number().over(first)).filter("nr = 1")
           .select("host", "path", F.concat("r_host", "r_path").alias("rule"),
                   F.when(F.col("r_block"), BLOCK).otherwise(ALLOW).alias("r_verdict")))
    return (urls.join(won, ["host", "path"], "left")
            .select("page_id", "host", "path", "rule", F.coalesce("r_verdict", F.lit(default)).alias("verdict")))
