"""URL filters as a sort-merge range join.

A host is turned round, label by label (``www.example.com`` -> ``com.example.www.``),
so that a rule for a host and its subdomains is an interval of keys that share a
prefix. URLs are range-partitioned and sorted by that key; each partition is swept
once beside the sorted rules, with a stack of the nested rules that are open at the
current key. Equal URLs may fill a third of the table: the row number is the last
part of the range key, so they still spread over many partitions.

Defined cases: a null URL or one without ``://`` has empty host and path and gets the
default verdict; repeated rows and null ids are kept as they are; an empty table or
an empty rule list gives no match; other columns of the input are not read. The
longest rule (characters of host and path together) wins, on a tie the one with the
longer host, then ``block``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import LOWER, UPPER

#: Rules swept at a time; more rules make more (narrow) sweeps over the sorted rows.
RULE_BLOCK = 100_000


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + F.lit(3))), F.lit(""))


def reversed_host(host: str) -> str:
    return "".join(f"{x}." for x in reversed(host.split("."))) if host else ""


def prepare(rules: Iterable[tuple[str, str, str]]) -> list[tuple[str, dict[str, tuple]]]:
    """(host, path, verdict) -> sorted [(reversed host, {path: (length, host length, is block, rule, verdict)})]."""
    by_host: dict[str, dict[str, tuple]] = {}
    for host, path, verdict in rules:
        host = host.translate(str.maketrans(UPPER, LOWER))
        if not host or verdict not in ("allow", "block"):
            raise ValueError(f"a rule needs a host and the verdict allow or block: {(host, path, verdict)}")
        entry = (len(host) + len(path), len(host), verdict == "block", host + path, verdict)
        paths = by_host.setdefault(reversed_host(host), {})
        paths[path] = max(entry, paths.get(path, entry))
    return sorted(by_host.items())


def sweep(rules: list[tuple[str, dict[str, tuple]]]):
    """Batches of rows sorted by ``__key`` -> the same rows with the best rule so far."""
    keys = [k for k, _ in rules]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[tuple[str, dict, list[int]]] = []
        at = None
        for pdf in batches:
            size, host_size, rule, verdict = (pdf[c].tolist() for c in ("__size", "__host_size", "rule", "verdict"))
            for i, (key, path) in enumerate(zip(pdf["__key"], pdf["path"], strict=True)):
                if at is None:  # open what encloses the partition's first key
                    at = bisect_left(keys, key.split(".", 1)[0])
                while at < len(keys) and keys[at] <= key:
                    while stack and not keys[at].startswith(stack[-1][0]):
                        stack.pop()
                    paths = rules[at][1]
                    stack.append((keys[at], paths, sorted({len(p) for p in paths}, reverse=True)))
                    at += 1
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                best = (size[i], host_size[i], verdict[i] == "block", rule[i], verdict[i])
                for _, paths, lengths in stack:
                    hit = next((paths[path[:n]] for n in lengths if path[:n] in paths), None)
                    if hit and hit[:3] > best[:3]:
                        best = hit
                size[i], host_size[i], _, rule[i], verdict[i] = best
            yield pdf.assign(__size=size, __host_size=host_size, rule=pd.Series(rule, dtype=object, index=pdf.index), verdict=pd.Series(verdict, dtype=object, index=pdf.index))

    return run


def filter_urls(
    pages: DataFrame, rules: Iterable[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """Judges every URL: (id, host, path, rule, verdict)."""
    ready = prepare(rules)
    rows = pages.select(F.col(id_col).alias(id_col), F.col(url_col).alias("__url")).select(
        F.col(id_col).alias("__id"), host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path")
    )
    labels = F.split("host", "\\.")
    rows = rows.select(
        "*",
        F.when(F.col("host") == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(labels), "."), F.lit("."))).alias("__key"),
        F.lit(-1).alias("__size"), F.lit(-1).alias("__host_size"),
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
        F.monotonically_increasing_id().alias("__row"),
    )
    rows = rows.repartitionByRange("__key", "path", "__row").sortWithinPartitions("__key", "path")
    for start in range(0, len(ready), RULE_BLOCK):
        rows = rows.mapInPandas(sweep(ready[start : start + RULE_BLOCK]), rows.schema)
    return rows.select(
        F.col("__id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
