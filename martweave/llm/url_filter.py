"""URL filters: allow and block rules of hosts and paths, by a sort-merge range join.

A rule has a host and a path. It fits its host and all subdomains of it, if the
url's path starts with the rule's path. The longest rule that fits wins.

Every url is written down once for each of its parent hosts that could be a
rule's host, as the key *reversed host, NUL, path*; a rule has one such key. In
byte order the urls that a rule fits are then one interval that begins at the
rule's own key, and two such intervals are nested or apart. Rules and urls are
dealt to the same key ranges, sorted, and swept with a stack of the rules that
are open: the rule on top is the longest one that fits. A rule that stays open
across the start of a range is given to that range as well, so a range needs
nothing from its neighbours.

Ranges are cut at sampled keys, which end with the row's own number, so one url
or one host with a third of all rows is cut as well. The sample decides only
where ranges begin, never a result. A task holds a stack as deep as rules are
nested; nothing is gathered by host, and the rules are not broadcast.

Defined cases:

* null url, or a url without ``://``: host and path are empty; such a row fits
  no rule and gets the default verdict. Empty urls and texts are no special case.
* A rule with a null or empty host or a null path fits nothing. Rules that are equal
  in host and path: the one that blocks counts. Hosts of rules are read without
  regard to the case of A-Z.
* "Longest" is the length of host and path together; of equally long rules the
  one with the longer host counts.
* Repeated rows and repeated or null page ids are judged one by one. Other columns
  of either table are ignored, whatever their names. Empty tables give no rows,
  and without rules everything gets the default verdict.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.llm.common import partitions, settled

ALLOW, BLOCK = "allow", "block"
SAMPLES_PER_RANGE = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEPARATOR = "\x00"  # before every other character, so a host's urls come before those of longer hosts


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; path: from there up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def reversed_host(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def rule_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``(verdict, host, path)`` rows as a table."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _ordered(rules: DataFrame) -> DataFrame:
    """One row per distinct rule: its text, length, host length, verdict, number of labels and sort key."""
    known = rules.select(
        F.col("verdict").cast("string").alias("verdict"),
        lower_ascii(F.col("host").cast("string")).alias("host"),
        F.col("path").cast("string").alias("path"),
    ).where("host <> '' AND path IS NOT NULL")
    known = known.groupBy("host", "path").agg(
        F.max(F.when(F.col("verdict") == BLOCK, BLOCK)).alias("blocks"), F.min("verdict").alias("verdict")
    )
    labels = F.split("host", r"\.")
    return known.select(
        F.concat("host", "path").alias("rule"),
        (F.length("host") + F.length("path")).cast("bigint").alias("size"),
        F.length("host").cast("bigint").alias("host_size"),
        F.coalesce("blocks", "verdict").alias("verdict"),
        F.size(labels).alias("labels"),
        F.length("path").alias("path_size"),
        F.concat(reversed_host(labels), F.lit(_SEPARATOR), F.col("path")).cast("binary").alias("key"),
    )


def _keys(urls: DataFrame, shape) -> DataFrame:
    """``key, rid``: one row per url and parent host that has as many labels as some rule's host.

    Paths are cut to the longest rule's path and hosts that are longer than every
    rule's are left out: neither can change which rules fit.
    """
    longest_host, longest_path, counts = shape
    labels = F.split("host", r"\.")
    parents = F.filter(F.array(*[F.lit(c) for c in counts]), lambda c: c <= F.size("parts"))
    parent = F.slice(F.col("parts"), F.size("parts") - F.col("c") + 1, F.col("c"))
    path = F.substring(F.col("path"), 1, longest_path)
    return (
        urls.where("host <> ''")
        .select("rid", path.alias("path"), labels.alias("parts"))
        .select("rid", "path", "parts", F.explode(parents).alias("c"))
        .select("rid", "path", reversed_host(parent).alias("anchor"))
        .where(F.length("anchor") <= longest_host)
        .select(F.concat("anchor", F.lit(_SEPARATOR), "path").cast("binary").alias("key"), "rid")
    )


def _cuts(keys: DataFrame, rows: int, ranges: int) -> list[tuple[bytes, int]]:
    """Where ranges begin: at most ``ranges - 1`` of a sample of about ``SAMPLES_PER_RANGE`` keys a range."""
    share = min(1.0, ranges * SAMPLES_PER_RANGE / max(rows, 1))
    found = sorted((bytes(k), r) for k, r in keys.sample(False, share, 7).select("key", "rid").toLocalIterator())
    step = max(1, -(-len(found) // ranges))
    return sorted(set(found[step::step]))


_EVENT = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("rid", T.LongType()),
        T.StructField("rule", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("host_size", T.LongType()),
        T.StructField("verdict", T.StringType()),
    ]
)
_MATCH = T.StructType([f for f in _EVENT.fields if f.name in ("rid", "rule", "size", "host_size", "verdict")])


def _dealt(events: DataFrame, cuts: list[tuple[bytes, int]], carried: bool) -> DataFrame:
    """``events`` with the number of their range; with ``carried`` also in all ranges at whose start they are open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rids = batch.column("key").to_pylist(), batch.column("rid").to_pylist()
            rows, parts = [], []
            for i, (key, rid) in enumerate(zip(keys, rids)):
                part = bisect_right(cuts, (key, rid))
                rows.append(i)
                parts.append(part)
                while carried and part < len(cuts) and cuts[part][0].startswith(key):
                    part += 1
                    rows.append(i)
                    parts.append(part)
            taken = batch.take(pa.array(rows, pa.int64()))
            columns = [pa.array(parts, pa.int32()), *[taken.column(f.name) for f in _EVENT.fields[1:]]]
            yield pa.RecordBatch.from_arrays(columns, names=_EVENT.names)

    return events.select(*_EVENT.names[1:]).mapInArrow(run, _EVENT)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches of sorted events (``part, key, rid``; a rule's rid is -1): the stack holds the rules whose interval is open."""
    stack: list[tuple[bytes, tuple]] = []
    current = None
    for batch in batches:
        found: list[tuple] = []
        columns = [batch.column(n).to_pylist() for n in _EVENT.names]
        for part, key, rid, *rule in zip(*columns):
            if part != current:
                stack, current = [], part
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rid < 0:
                stack.append((key, tuple(rule)))
            elif stack:
                found.append((rid, *stack[-1][1]))
        arrays = zip(*found) if found else [[]] * len(_MATCH)
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(list(a), t) for a, t in zip(arrays, types)], names=_MATCH.names)


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = ALLOW
) -> DataFrame:
    """``id_col, host, path, rule, verdict`` of every row of ``pages``.

    ``rules(verdict, host, path)`` may be of any size; ``default`` is the verdict
    of urls that no rule fits (the module's text defines all other cases).
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    # The number is made once and written, so it stays the same when a task is repeated.
    urls = settled(
        pages.select(F.col(id_col), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("rid")),
        "urls",
    )
    ordered = settled(_ordered(rules), "url-rules")
    longest = ordered.agg(F.max("host_size"), F.max("path_size"), F.array_sort(F.collect_set("labels"))).first()
    unmatched = F.lit(None).cast("string").alias("rule")
    if longest[0] is None:
        return urls.select(id_col, "host", "path", unmatched, F.lit(default).alias("verdict"))
    keys = _keys(urls, longest)
    ranges = partitions(pages.sparkSession)
    cuts = _cuts(keys, keys.count(), ranges)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in _EVENT.fields[3:]]
    events = _dealt(keys.select("key", "rid", *nothing), cuts, False).unionAll(
        _dealt(ordered.withColumn("rid", F.lit(-1).cast("bigint")), cuts, True)
    )
    # A range is a partition: its number is the partition's.
    matches = (
        events.repartitionById(len(cuts) + 1, "part").sortWithinPartitions("part", "key", "rid").mapInArrow(_sweep, _MATCH)
    )
    best = matches.groupBy("rid").agg(F.max(F.struct("size", "host_size", "rule", "verdict")).alias("best"))
    return urls.join(best, "rid", "left").select(
        id_col,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
