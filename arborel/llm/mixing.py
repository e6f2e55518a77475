"""Mixing sources to target weights by Poisson replication.

Each listed source gets a mean repetition rate such that its expected share of the result is
its weight. Every document draws its number of copies from the Poisson distribution of that
mean, by inverting it at a uniform number hashed from seed and doc_id; so draws do not depend
on partitions, order or retries. The copies are dealt over all partitions by a hash of
document and copy and ordered in each by it, which mixes them globally; copies of one
document, and the documents of one source, land apart.

All of this is DataFrame expressions. What the plan holds grows with the weights given, not
with the data: sources that are not listed, and null, are one group with the weight ``rest``.

Documents of equal id draw alike. A row without id draws by all that it holds, so that only rows equal
in every column draw alike. A weight of 0 drops a
source; a listed source without documents leaves its share to the others. Extra columns pass
through; ``copy`` (from 1) and ``shuffle_key`` get underscores in front where they clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborel.llm.common import fresh

#: Larger means are drawn as a sum of this or smaller ones, whose probabilities doubles can hold.
LARGEST_MEAN = 64.0
_DIGITS = 13  # hexadecimal digits of a hash that make a uniform number: 52 bits


def _hashed(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))), 1, _DIGITS), 16, 10).cast("long")


def poisson_table(mean: float) -> list[float]:
    """Cumulative probabilities of 0, 1, ... copies, up to where doubles end."""
    p = total = math.exp(-mean)
    table, k = [total], 0
    while k < mean or p > 2.0**-56:
        k += 1
        p = p * mean / k
        total += p
        table.append(total)
    return table


def source_rates(docs: DataFrame, weights: dict[str, float], rest: float = 0.0, source: str = "source", size: float = 1.0) -> dict[str | None, float]:
    """Mean copies of a document by source, None for the rest; the result has ``size`` times as many documents as the input.

    Sources are counted before anything is shuffled; at most len(weights) + 1 counts come back.
    """
    group = F.when(F.col(source).isin(list(weights)), F.col(source))
    counts = {r[0]: r[1] for r in docs.select(group.alias("group")).groupBy("group").count().collect()}
    shares = {s: w for s, w in [*weights.items(), (None, rest)] if counts.get(s) and w > 0}
    total = sum(shares.values())
    if not total:
        return {}
    n = sum(counts.values()) * size
    return {s: n * w / total / counts[s] for s, w in sorted(shares.items(), key=lambda x: str(x[0]))}


def identity(docs: DataFrame, doc_id: str = "doc_id") -> Column:
    """What a row draws by: its id, or a hash of the row where the id is null."""
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("row "), F.xxhash64(*hashed).cast("string")))


def copies_of(rates: dict[str | None, float], seed: int, source: str = "source", draws_by: Column | None = None) -> Column:
    """Number of copies of a row, drawn by ``draws_by``, usually its id."""
    draws_by = F.col("doc_id") if draws_by is None else draws_by

    def drawn(mean: float) -> Column:
        parts = max(1, math.ceil(mean / LARGEST_MEAN))
        table = F.array(*(F.lit(p) for p in poisson_table(mean / parts)))

        def one(i: Column) -> Column:
            u = (_hashed(F.lit(seed), draws_by, i) + F.lit(0.5)) / F.lit(16.0**_DIGITS)
            return F.size(F.filter(table, lambda c: c <= u))

        if parts == 1:
            return one(F.lit(0))
        return F.aggregate(F.sequence(F.lit(0), F.lit(parts - 1)), F.lit(0), lambda n, i: n + one(i))

    out = F.when(F.lit(False), F.lit(0))
    for s, mean in rates.items():
        if s is not None:
            out = out.when(F.col(source) == s, drawn(mean))
    listed = [s for s in rates if s is not None]
    left = F.lit(0)
    if None in rates:
        left = drawn(rates[None])
    return out.otherwise(left) if listed or None in rates else F.lit(0)


def mix(docs: DataFrame, weights: dict[str, float], rest: float = 0.0, seed: int = 0, size: float = 1.0, source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with each row as often as drawn, shuffled globally; adds ``copy`` and ``shuffle_key``."""
    rates = source_rates(docs, weights, rest, source, size)
    # a source that is listed but has no rate is not one of the rest
    known = {s: rates.get(s, 0.0) for s in weights}
    if None in rates:
        known[None] = rates[None]
    copy, key = fresh(docs, "copy"), fresh(docs, "shuffle_key")
    own = identity(docs, doc_id)
    n = copies_of(known, seed, source, own)
    held = fresh(docs, "draws_by")
    rows = docs.withColumn(held, own).withColumn(copy, F.explode(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))))
    rows = rows.withColumn(key, _hashed(F.lit(seed), F.col(held), F.col(copy), F.lit("order"))).drop(held)
    return rows.repartition(key).sortWithinPartitions(key)


def rates_sql(weights: dict[str, float], table: str = "documents") -> str:
    """DuckDB SQL for (source, rate) of listed sources only, with rest = 0 and size = 1."""
    listed = ", ".join(f"('{s}', CAST({w!r} AS DOUBLE))" for s, w in weights.items())
    return f"""w(source, weight) AS (VALUES {listed}),
n AS (SELECT source, count(*) AS docs FROM {table} GROUP BY source),
total AS (SELECT CAST(sum(docs) AS DOUBLE) AS docs FROM n),
present AS (SELECT w.source, w.weight, n.docs FROM w JOIN n USING (source) WHERE w.weight > 0),
rates AS (SELECT source, total.docs * weight / (SELECT sum(weight) FROM present) / present.docs AS mean FROM present, total)"""


def mix_sql(weights: dict[str, float], seed: int, table: str = "documents", columns: str = "doc_id, source") -> str:
    """DuckDB SQL for ``mix`` with means of at most LARGEST_MEAN: ``columns``, copy and shuffle_key."""
    kept = ", ".join(f"d.{c.strip()}" for c in columns.split(","))
    return f"""WITH {rates_sql(weights, table)},
terms AS (SELECT source, k, exp(-mean + k * ln(mean) - lgamma(CAST(k + 1 AS DOUBLE))) AS p FROM rates, range(0, 200) r(k)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS upto FROM terms),
drawn AS (SELECT doc_id, source, (CAST('0x' || substr(md5('{seed}|' || doc_id || '|0'), 1, 13) AS BIGINT) + 0.5e0) / 4503599627370496e0 AS u FROM {table}),
copies AS (SELECT drawn.doc_id, count(*) AS n FROM drawn JOIN cdf ON cdf.source = drawn.source AND cdf.upto <= drawn.u GROUP BY drawn.doc_id)
SELECT {kept}, CAST(c.copy AS INTEGER) AS copy, CAST('0x' || substr(md5('{seed}|' || d.doc_id || '|' || c.copy || '|order'), 1, 13) AS BIGINT) AS shuffle_key
FROM {table} d JOIN copies ON copies.doc_id = d.doc_id, LATERAL (SELECT unnest(range(1, copies.n + 1)) AS copy) c"""
