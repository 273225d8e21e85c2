"""Links between similar sets from shared bucket keys, and their connected components.

A bucket may hold a third of all rows, so its pairs are never listed. Every member is first
compared with one member of its bucket, the one that shares buckets with most others and so is
likely to be similar to many; then with the first such member outside that one's component.
Members that are linked become one component. What is left are members of different components
in one bucket: for those a prefix filter finds the pairs that can still be similar. Two sets of Jaccard similarity s or more
share one of their n - ceil(s n) + 1 rarest elements, so elements that one set alone has, or
that most sets have, bring no pairs. No pair is lost: a pair in a bucket is in one component or
goes through the filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from reelframe.llm.workers import map_rows, stored

#: Links that one task settles at once; more go through rounds of shuffles.
MOST_AT_ONCE = 2_000_000


def settled(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of links (u, v) but the least of each component, and that one."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    least, (a, b) = np.arange(len(nodes)), ends.reshape(2, -1)
    while (least[a] != least[b]).any():
        low, high = np.minimum(least[a], least[b]), np.maximum(least[a], least[b])
        np.minimum.at(least, high, low)
        while (least[least] != least).any():
            least = least[least]
    others = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[others], nodes[least[others]]


def at_once(pairs: DataFrame) -> DataFrame:
    """(id, component) from few links (u, v), in one task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        links = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
        if links:
            ids, found = settled(*map(np.concatenate, zip(*links, strict=True)))
            yield {"id": ids, "component": found}

    return map_rows(pairs.coalesce(1), task, "id long, component long")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all nodes but the least of each component, from links (a, b).

    Few links of numbers are settled in one task. Of more, large and small stars by turns: each
    node's larger, then its smaller neighbours are tied to the least one it sees, until nothing
    changes. Each round's links are a written table.
    """
    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    pairs = stored(links.where(F.col("a") != F.col("b")).select(u, v).distinct(), "links")
    if {kind for _, kind in pairs.dtypes} == {"bigint"} and pairs.count() <= MOST_AT_ONCE:
        return stored(at_once(pairs), "components")
    before = None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = state
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stored(small.union(least).distinct(), "links")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, na, b, nb) those (a, b) whose whole sets have this Jaccard similarity in percent."""
    alike = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    small = pairs.where(alike).distinct()
    left = small.join(sets.select(F.col("id").alias("a"), F.col("h").alias("ha")), "a")
    held = left.join(sets.select(F.col("id").alias("b"), F.col("h").alias("hb")), "b")
    shared = F.size(F.array_intersect("ha", "hb"))
    return held.where(100 * shared >= percent * (F.col("na") + F.col("nb") - shared)).select("a", "b").distinct()


def crowded(members: DataFrame) -> DataFrame:
    """(key, id, n, company) in buckets with more than one id, from (key, id, n); ``company`` is the
    sum of the sizes of an id's buckets, by which the middle of a group of near copies stands out."""
    sizes = members.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("low"), F.max("id").alias("high"))
    shared = stored(members.join(sizes.where("low < high").select("key", "size"), "key"), "shared")
    company = shared.groupBy("id").agg(F.sum("size").alias("company"))
    return shared.select("key", "id", "n").join(company, "id")


def leaders(members: DataFrame) -> DataFrame:
    """(key, b, nb, of): the id of each bucket with the most company, of equal ones the largest,
    with its size and component."""
    first = members.groupBy("key").agg(F.max(F.struct("company", "id", "n", "component")).alias("first"))
    named = {"b": "first.id", "nb": "first.n", "of": "first.component"}
    return first.select("key", *[F.col(field).alias(name) for name, field in named.items()])


def unsettled(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members, with their component, of buckets that hold more than one component."""
    own = members.drop("component").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    ends = own.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return own.join(ends.where("least < most").select("key"), "key", "left_semi")


def by_prefix(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share one of their rarest elements.

    With elements in one order, rarest first, the first one that two sets share, at places i and
    j, leaves room for at most 1 + min(na - i, nb - j) shared ones; a pair of this similarity
    needs percent / (100 + percent) of na + nb.
    """
    held = rest.join(sets.select("id", "h"), "id")
    elements = stored(held.select("id", "n", "component", F.explode("h").alias("e")), "elements")
    common = elements.groupBy("e").agg(F.count("*").alias("seen")).where("seen > 1")
    own = Window.partitionBy("id")
    ranked = elements.join(common, "e").select(
        "id",
        "n",
        "component",
        "e",
        (F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("seen", "e"))).alias("place"),
    )
    prefix = stored(ranked.where(F.expr(f"place <= n - ({percent} * n + 99) div 100 + 1")), "prefix")
    a, b = prefix.toDF("a", "na", "ca", "e", "i"), prefix.toDF("b", "nb", "cb", "e", "j")
    alike = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    room = 1 + F.least(F.col("na") - F.col("i"), F.col("nb") - F.col("j"))
    enough = (100 + percent) * room >= percent * (F.col("na") + F.col("nb"))
    return a.join(b, "e").where((F.col("ca") < F.col("cb")) & alike & enough).select("a", "na", "b", "nb").distinct()


#: Rounds in which the members of a bucket are compared with one of them.
ROUNDS = 2


def link(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, component) from the ``crowded`` members of buckets and whole sets (id, n, h).

    A leader that all members of its bucket have been compared with leaves the bucket, so a
    bucket of two is settled by one comparison.
    """
    rest, found, links = members.withColumn("component", F.col("id")), None, None
    for _ in range(ROUNDS):
        led = stored(rest.join(leaders(rest), "key").where("id <> b"), "led")
        stars = led.where("component <> of").select(F.col("id").alias("a"), F.col("n").alias("na"), "b", "nb")
        fresh = verified(stars, sets, percent)
        links = stored(links.union(fresh) if links else fresh, "verified")
        found = components(links)
        rest = stored(unsettled(led.drop("b", "nb", "of"), found), "unsettled")
        if rest.isEmpty():
            return found
    rest = rest.select("id", "n", "component").distinct()
    links = links.union(verified(by_prefix(rest, sets, percent), sets, percent))
    return components(links)
