"""Finding windows that occur more than once in a corpus, without moving the corpus.

The texts are sequences of units (bytes or words). A rolling hash of ``gram`` units runs over them,
and the least hash among those that a window contains is the window's trigger. So a window's
content alone decides its trigger, and consecutive windows with one trigger form a *phrase*. Equal
windows always have equal triggers, and most of the rest follows from phrases:

1. Triggers are counted. A window whose trigger is unique is unique; most of a corpus ends here,
   as one number for each phrase.
2. The phrases of repeated triggers are the dictionary. Occurrences of the same phrase repeat all
   its windows, whatever text they are in.
3. What is left is to compare *different* phrases with the same trigger, once each. They go to
   shards by trigger, and a shard compares the windows of its phrases exactly.

A trigger with very many different phrases is not kept together: its phrases are cut into single
windows, and those are a dictionary of their own, combined on the map side like the first.
Positions are counted in units from the start of the text. Rows that agree in id and text are
treated alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import BROADCAST_BYTES, mapped, row_key
from tidemark.session import materialized, split_count

PIECE = 1 << 19  # units hashed at once
SLICE_BYTES = 4 << 20  # text looked at in one go
SHARD_PHRASES = 1 << 11
ASKED_AT_ONCE = 1 << 12  # phrases cut out in one go
# With more different phrases than this, a trigger's windows are dealt out one by one.
CROWDED = 1 << 11
ODD = np.uint64(0x9E3779B97F4A7C15)


class Kind(NamedTuple):
    """``read`` gives the units of some texts in a row and how many each text has; ``lift`` hashes units."""

    window: int
    gram: int
    read: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
    lift: Callable[[np.ndarray], np.ndarray]

    @property
    def grams(self) -> int:
        """How many grams a window contains."""
        return self.window - self.gram + 1


def scrambled(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes of all stretches of a sequence, from sums of its prefixes (modulo 2^64)."""

    powers = np.ones(1, np.uint64)
    inverse = np.ones(1, np.uint64)

    def __init__(self, values: np.ndarray):
        n = len(values)
        if len(Rolling.powers) <= n:
            back = pow(int(ODD), -1, 1 << 64)
            Rolling.powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, ODD)])
            Rolling.inverse = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, np.uint64(back))])
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.powers[:n], out=self.sums[1:])

    def every(self, length: int) -> np.ndarray:
        diff = self.sums[length:] - self.sums[: len(self.sums) - length]
        return scrambled(diff * self.inverse[: len(diff)])

    def at(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        diff = (self.sums[start + length] - self.sums[start]) * self.inverse[start]
        return scrambled(diff + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[: len(x) - done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def phrases(kind: Kind, units: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Text number, first window, number of windows, trigger hash and content hash of every phrase."""
    ends = np.cumsum(lengths)
    total, extra = len(units), kind.window - 1
    for p0 in range(0, total, PIECE):
        p1 = min(total, p0 + PIECE)
        part = kind.lift(units[p0 : p1 + extra])
        part = np.r_[part, np.zeros(p1 - p0 + extra - len(part), np.uint64)]
        rolling = Rolling(part)
        grams = rolling.every(kind.gram)
        at = np.arange(p0, p1)
        text = np.searchsorted(ends, at, "right")
        valid = at + kind.window <= ends[text]
        # The place in the low bits: of equal hashes the first wins, in every copy alike. As many bits in every
        # piece, however short it is: the same hash bits must decide wherever a window lies.
        low = np.uint64((1 << (PIECE + extra).bit_length()) - 1)
        least = sliding_least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), kind.grams)
        trigger = (least & low).astype(np.int64)
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (trigger[1:] != trigger[:-1])
        first = np.flatnonzero(new)
        if not len(first):
            continue
        # A phrase ends before the next one, or where windows end.
        stop = np.flatnonzero(np.diff(np.r_[valid, False].astype(np.int8)) == -1) + 1
        last = np.minimum(np.r_[first[1:], p1 - p0], stop[np.searchsorted(stop, first, "right")])
        count = last - first
        owner = text[first]
        starts = first + p0 - (ends - lengths)[owner]
        yield owner, starts, count, grams[trigger[first]], rolling.at(first, count + extra)


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text each."""
    sizes = np.array([x.as_buffer().size if x.is_valid else 0 for x in batch.column(column)])
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // size)) + 1
    bounds = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(bounds, bounds[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    return docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), text)


def occurrences(rows: DataFrame, kind: Kind) -> DataFrame:
    """Every phrase of every text: ``id``, ``key``, ``start``, ``n`` windows, ``trigger``, ``phrase``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids, keys = part.column("id"), part.column("key")
                for owner, start, count, trigger, phrase in phrases(kind, *kind.read(part.column("text"))):
                    who = pa.array(owner)
                    numbers = [start, count.astype(np.int32), trigger.view(np.int64), phrase.view(np.int64)]
                    columns = [ids.take(who), keys.take(who), *[pa.array(x) for x in numbers]]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "key", "start", "n", "trigger", "phrase"])

    long = lambda name: T.StructField(name, T.LongType())
    fields = [rows.schema["id"], long("key"), long("start"), T.StructField("n", T.IntegerType()), long("trigger"), long("phrase")]
    return mapped(rows, run, T.StructType(fields))


def same_row(a: DataFrame, b: DataFrame):
    return (a["key"] == b["_key"]) & a["id"].eqNullSafe(b["_id"])


def dictionary(found: DataFrame) -> DataFrame:
    """Every different phrase with its first place and its number of places."""
    place = F.min(F.struct("id", "key", "start", "n")).alias("first")
    return found.groupBy("trigger", "phrase").agg(place, F.count(F.lit(1)).alias("c"))


def copies(found: DataFrame, entries: DataFrame, keep_first: bool) -> DataFrame:
    """The stretches of phrases that occur more than once, but for the first if that is to stay."""
    copied = entries.filter("c > 1").select("trigger", "phrase", "first")
    out = found.join(copied, ["trigger", "phrase"])
    if keep_first:
        here, there = F.struct("id", "key", "start"), F.struct("first.id", "first.key", "first.start")
        out = out.filter(~here.eqNullSafe(there))
    return out.select("id", "key", "start", "n")


def tagged(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"key": "_key", "id": "_id"})


def removed_runs(
    docs: DataFrame,
    kind: Kind,
    compare: Callable[[pa.Table], pa.Table],
    keep_first: bool,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All rows as ``id``, ``text`` (binary) and ``runs``: what their repeated windows cover, null for none.

    With ``keep_first`` the earliest of equal windows, by id, row and position, is not repeated.
    ``compare`` gets the different phrases of a shard (``id``, ``key``, ``start``, ``n``, ``units``)
    and returns the repeated windows among them as stretches ``id``, ``key``, ``start``, ``n``.
    """
    rows = keyed(docs, id_col, text_col)
    seen = occurrences(rows, kind)
    again = seen.groupBy("trigger").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("trigger")
    # Repeated triggers grow with the corpus: a plain join, split where a trigger is hot.
    found = materialized(seen.join(materialized(again, "triggers"), "trigger", "left_semi"), "phrases")

    # The dictionary, with the first place and the number of places of each phrase.
    entries = materialized(dictionary(found), "dictionary")
    settled = copies(found, entries, keep_first)

    crowd = entries.groupBy("trigger").agg(F.count(F.lit(1)).alias("crowd")).filter("crowd > 1")
    unsettled = entries.join(crowd, "trigger").select("first.*", "trigger", (F.col("crowd") > CROWDED).alias("crowded"))
    unsettled = materialized(unsettled, "unsettled")
    # Enough shards for every task to have some, however many phrases there are.
    spark = docs.sparkSession
    shards = max(4 * split_count(spark), unsettled.filter("not crowded").count() // SHARD_PHRASES)
    asked = unsettled.groupBy("key", "id").agg(F.collect_list(F.struct("start", "n", "trigger", "crowded")).alias("asked"))
    asked = by_size(materialized(tagged(asked), "asked"), "asked", 24)
    texts = rows.join(asked, same_row(rows, asked)).select("id", "key", "text", "asked").dropDuplicates(["id", "key"])
    cuts = materialized(cut_out(texts, kind), "cut-out")
    together = cuts.filter("units is not null").withColumn("shard", F.pmod("trigger", F.lit(shards)))
    flagged = together.groupBy("shard").applyInArrow(compare, stretch_schema(rows))
    # Different windows have nothing in common: their dictionary settles them.
    single = cuts.filter("units is null").drop("units")
    # Written, so that the join has a plain shuffle on both sides and a hot window can be split.
    windows = materialized(dictionary(single), "windows")
    settled = settled.union(copies(single, windows, keep_first))

    # Stretches of windows become stretches of units, and those that touch become one.
    covers = settled.union(flagged).distinct()
    covers = covers.select("id", "key", "start", (F.col("start") + F.col("n") + kind.window - 1).alias("stop"))
    order = W.partitionBy("key", "id").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(W.unboundedPreceding, -1))
    fresh = (before.isNull() | (F.col("start") > before)).cast("int")
    numbered = covers.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order))
    runs = numbered.groupBy("key", "id", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    runs = runs.groupBy("key", "id").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("runs"))
    runs = materialized(tagged(runs), "runs")
    side = by_size(runs, "runs", 16)
    return rows.join(side, same_row(rows, side), "left").select("id", "text", "runs")


def by_size(lists: DataFrame, column: str, entry_bytes: int) -> DataFrame:
    """A written table with a list in each row, marked for broadcast if all its entries are few enough."""
    total = lists.agg(F.coalesce(F.sum(F.size(column) * entry_bytes + 64), F.lit(0)).alias("n")).first()["n"]
    return F.broadcast(lists) if total <= BROADCAST_BYTES else lists


def stretch_schema(rows: DataFrame) -> T.StructType:
    long = lambda name: T.StructField(name, T.LongType())
    return T.StructType([rows.schema["id"], long("key"), long("start"), T.StructField("n", T.IntegerType())])


def cut_out(texts: DataFrame, kind: Kind) -> DataFrame:
    """The asked phrases with their units; those of crowded triggers as single windows by their hash alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                units, lengths = kind.read(part.column("text"))
                lists = part.column("asked")
                owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy())
                asked = [lists.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(4)]
                at = (np.cumsum(lengths) - lengths)[owner] + asked[0]
                for k in range(0, len(owner), ASKED_AT_ONCE):
                    some = slice(k, k + ASKED_AT_ONCE)
                    yield pieces(kind, part, units, at[some], owner[some], *[x[some] for x in asked])

    more = [T.StructField("trigger", T.LongType()), T.StructField("phrase", T.LongType()), T.StructField("units", T.BinaryType())]
    return mapped(texts, run, T.StructType([*stretch_schema(texts), *more]))


def pieces(kind: Kind, part: pa.RecordBatch, units, at, owner, start, n, trigger, crowded) -> pa.RecordBatch:
    """What :func:`cut_out` gives for some phrases, which are ``at`` these places of ``units``."""
    many = n + kind.window - 1
    whole, single = np.flatnonzero(~crowded), np.flatnonzero(crowded)
    cuts = [units[at[i] : at[i] + many[i]] for i in single]
    rolling = Rolling(kind.lift(np.concatenate(cuts) if cuts else units[:0]))
    counts = n[single]
    each = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.repeat(np.cumsum(many[single]) - many[single], counts) + each
    hashes = rolling.at(begin, np.full(len(begin), kind.window)).view(np.int64)
    of = np.repeat(single, counts)
    row = np.r_[whole, of]
    who = pa.array(owner[row])
    contents = [units[at[i] : at[i] + many[i]].tobytes() for i in whole] + [None] * len(of)
    columns = [
        part.column("id").take(who),
        part.column("key").take(who),
        pa.array(np.r_[start[whole], start[of] + each]),
        pa.array(np.r_[n[whole], np.ones(len(of), n.dtype)].astype(np.int32)),
        pa.array(trigger[row]),
        pa.array(np.r_[np.zeros(len(whole), np.int64), hashes]),
        pa.array(contents, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["id", "key", "start", "n", "trigger", "phrase", "units"])


def stretches(table: pa.Table, owner: np.ndarray, offset: np.ndarray) -> pa.Table:
    """Windows (row of ``table`` and offset in it, both ascending) as stretches of neighbours."""
    new = np.r_[True, (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)] if len(owner) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(owner)])
    who = pa.array(owner[first])
    start = table.column("start").to_numpy()[owner[first]] + offset[first]
    columns = [table.column("id").take(who), table.column("key").take(who), pa.array(start), pa.array(count.astype(np.int32))]
    return pa.table(columns, ["id", "key", "start", "n"])
