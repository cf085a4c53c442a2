"""URL verdicts from allow and block entries, longest match first.

Entries form a trie over reversed host labels; each host node holds a trie over path segments. The trie
goes to the executors as a broadcast, which ``max_rules`` and ``max_bytes`` bound. Larger rule sets are
joined instead: an url meets the rules of its host suffixes and path folders by equality.

An entry fits its host and all subdomains if the url's path starts with the entry's path. Of the entries
that fit, the one with most host labels wins, then the longest path; of equal entries, block wins.

Defined cases: a null url, or one without ``://``, has an empty host and path, so only the default verdict
applies. Repeated rows each get their verdict. An empty table gives an empty result. Further columns of the
input are not read, whatever their names; ``keep`` names those to carry along.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.llm.common import LOWER, UPPER, slices

#: (verdict, host, path)
Rule = tuple[str, str, str]
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_AZ = str.maketrans(UPPER, LOWER)


class PathNode:
    """Segments below, and the entries that end here with a part of the next segment."""

    __slots__ = ("below", "ends", "sizes")

    def __init__(self):
        self.below: dict[str, PathNode] = {}
        self.ends: dict[str, tuple[str, str]] = {}
        self.sizes: tuple[int, ...] = ()

    def add(self, segments: list[str], verdict: str, rule: str) -> None:
        if len(segments) > 1:
            self.below.setdefault(segments[0], PathNode()).add(segments[1:], verdict, rule)
        elif self.ends.get(segments[0], ("allow",))[0] != "block":
            self.ends[segments[0]] = (verdict, rule)
            self.sizes = tuple(sorted({len(e) for e in self.ends}, reverse=True))

    def longest(self, segments: list[str], at: int = 0) -> tuple[str, str] | None:
        deeper = self.below.get(segments[at]) if at + 1 < len(segments) else None
        found = deeper.longest(segments, at + 1) if deeper else None
        if found is None:
            here = segments[at]
            found = next((self.ends[here[:n]] for n in self.sizes if here[:n] in self.ends), None)
        return found


class HostNode:
    """Labels below, from the top-level domain down, and the paths of the entries for this host."""

    __slots__ = ("below", "paths")

    def __init__(self):
        self.below: dict[str, HostNode] = {}
        self.paths: PathNode | None = None


class Trie:
    def __init__(self, rules: Iterable[Rule]):
        self.root = HostNode()
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.translate(_AZ).split(".")):
                node = node.below.setdefault(label, HostNode())
            node.paths = node.paths or PathNode()
            node.paths.add(path.split("/"), verdict, host.translate(_AZ) + path)

    def verdict(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, entry) of the longest match, or None."""
        node, found, segments = self.root, None, path.split("/")
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            if node.paths:
                found = node.paths.longest(segments) or found
        return found


def with_url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty for a null url or one without ``://``."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    return df.withColumns({
        "host": F.translate(F.regexp_extract(text, URL_PARTS, 1), UPPER, LOWER),
        "path": F.regexp_extract(text, URL_PARTS, 2),
    })


def _by_trie(df: DataFrame, rules: Sequence[Rule], default: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(Trie(rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        for batch in slices(batches, 10_000):
            found = [
                trie.verdict(h, p) or (default, None)
                for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[1] for f in found], pa.string()),
                 pa.array([f[0] for f in found], pa.string())],
                names=[*batch.schema.names, "rule", "verdict"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(judge, f"{kinds}, rule string, verdict string")


def _by_join(df: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same verdicts without a broadcast: equality on host suffix and path folder, then the tail."""
    rules = rules.select(
        F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"),
        F.col("verdict").alias("r_verdict"),
    ).withColumn("r_dir", F.regexp_extract("r_path", "(?s)^(.*/)?", 0))
    parts = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    bits = F.split("path", "/")
    dirs = F.transform(
        F.sequence(F.lit(1), F.size(bits)),
        lambda i: F.when(i == 1, F.lit("")).otherwise(F.concat(F.array_join(F.slice(bits, 1, i - 1), "/"), F.lit("/"))),
    )
    # Equal urls ask once, however often they occur.
    asked = df.select("host", "path").distinct()
    met = (
        asked.withColumn("r_host", F.explode(hosts)).withColumn("r_dir", F.explode(dirs))
        .join(rules, ["r_host", "r_dir"]).filter(F.expr("startswith(path, r_path)"))
    )
    rank = F.struct(F.size(F.split("r_host", r"\.")), F.length("r_path"), F.col("r_verdict") == "block")
    best = met.groupBy("host", "path").agg(F.max_by(F.struct("r_host", "r_path", "r_verdict"), rank).alias("best"))
    return df.join(best, ["host", "path"], "left").select(
        *df.columns, F.concat("best.r_host", "best.r_path").alias("rule"),
        F.coalesce("best.r_verdict", F.lit(default)).alias("verdict"),
    )


def judge_urls(
    df: DataFrame, rules: Sequence[Rule] | DataFrame, url: str = "url", keep: Sequence[str] = (),
    default: str = "allow", max_rules: int = 100_000, max_bytes: int = 8_000_000,
) -> DataFrame:
    """``keep`` columns with ``host``, ``path``, ``rule`` (null: none fits) and ``verdict``.

    ``rules`` are tuples or a table (verdict, host, path). Up to ``max_rules`` entries with ``max_bytes``
    of text they are broadcast as a trie; beyond, they are joined. Both give the same verdicts.
    """
    asked = with_url_parts(df.select(*keep, F.col(url).alias("__url")), "__url").drop("__url")
    if isinstance(rules, DataFrame):
        table = rules.select("verdict", "host", "path").dropna()
        size = table.agg(F.count("*"), F.sum(F.octet_length("host") + F.octet_length("path"))).first()
        if size[0] > max_rules or (size[1] or 0) > max_bytes:
            return _by_join(asked, table, default)
        rules = [tuple(r) for r in table.collect()]
    if len(rules) > max_rules or reduce(lambda n, r: n + len(r[1]) + len(r[2]), rules, 0) > max_bytes:
        table = df.sparkSession.createDataFrame(rules, "verdict string, host string, path string")
        return _by_join(asked, table, default)
    return _by_trie(asked, rules, default)
