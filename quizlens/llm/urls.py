"""URL filter: a trie over reversed host labels and then path segments decides between allow and block entries.

A rule is (host, path, verdict). It fits its host and all subdomains when the url's path starts with the rule's path; of several that fit
the longest wins, by host labels first, then by path; of two rules with the same host and path the blocking one counts. The trie goes to
the tasks as one broadcast; `MAX_RULES` bounds its size and a longer list is refused, so the broadcast cannot grow with the pages.

Defined results: a null url, or one without `://`, has an empty host and path, fits no rule and gets the default verdict. The host is
compared in lower case (A-Z). An empty path fits only rules whose path is empty. Repeated rows are judged each for itself; an empty
table gives an empty result. Other columns are carried along; columns named as the output's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 1_000_000
Rule = tuple[str, str, str]


class Trie:
    """Host labels from the last to the first, then path segments. A rule's last segment may end inside a segment of the url,
    so each node keeps those ends in a dict of its own, searched from the longest."""

    __slots__ = ("labels", "segments", "ends")

    def __init__(self):
        self.labels: dict[str, Trie] = {}
        self.segments: dict[str, Trie] = {}
        self.ends: dict[str, tuple[str, str]] = {}  # start of a segment -> rule, verdict

    def add(self, host: str, path: str, verdict: str) -> None:
        node = self
        for label in reversed(host.split(".")):
            node = node.labels.setdefault(label, Trie())
        *whole, last = path.split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, Trie())
        if node.ends.get(last, ("", ""))[1] != "block":
            node.ends[last] = (host + path, verdict)

    def _on_path(self, segments: list[str]) -> tuple[str, str] | None:
        best, node = None, self
        for k, segment in enumerate(segments):
            if node.ends:
                longest = min(len(segment), max(map(len, node.ends)))
                best = next((node.ends[segment[:n]] for n in range(longest, -1, -1) if segment[:n] in node.ends), best)
            if k + 1 == len(segments) or segment not in node.segments:
                break
            node = node.segments[segment]
        return best

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        node, found, segments = self, None, path.split("/")
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            found = node._on_path(segments) or found
        return found


def build(rules: Iterable[Rule]) -> Trie:
    trie, n = Trie(), 0
    for host, path, verdict in rules:
        n += 1
        if n > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules: the trie would be too large to broadcast")
        if verdict not in ("allow", "block"):
            raise ValueError(f"a verdict is allow or block, not {verdict!r}")
        trie.add(host.lower(), path, verdict)
    return trie


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """pages without `url`, with host, path, rule and verdict."""
    new = ("host", "path", "rule", "verdict")
    rest = [c for c in pages.columns if c not in (url, *new)]
    given = pages.select(*[pages[c] for c in rest], host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    schema = given.select("*", F.lit(None).cast("string").alias("rule"), F.lit("").alias("verdict")).schema
    trie = pages.sparkSession.sparkContext.broadcast(build(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [trie.value.match(h, p) if h else None for h, p in zip(b.column("host").to_pylist(), b.column("path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([f and f[0] for f in found], pa.string()), pa.array([f[1] if f else default for f in found], pa.string())],
                [*b.schema.names, "rule", "verdict"])

    return given.mapInArrow(run, schema)
