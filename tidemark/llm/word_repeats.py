"""Removal of repeated word sequences, with a compressed FM-index for every shard.

Phrases whose triggers occur once are settled beforehand, and places with equal phrases by their order
(see ``repeats``). The different phrases around the other triggers are dealt to shards. A shard
indexes its phrases: the Burrows-Wheeler transform as a wavelet matrix over bit-packed vectors with
block ranks. Then the windows of all its phrases stream through backward search, all at once, a word
a step. A window leaves the search when it matches nothing but itself; the steps it took are its
matching statistic. Windows that reach the threshold find in their suffix interval the earliest place
that has them.

Defined cases: null texts have no words, texts shorter than a window lose nothing, windows never
cross documents. Earlier means a smaller id (null first), among rows with one id a smaller row
hash, within a row an earlier start. Rows that agree in id and text are treated alike, as the one
document they are. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import mapped
from tidemark.llm import repeats
from tidemark.llm.byte_repeats import left

WINDOW_WORDS = 20
GRAM_WORDS = 8


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, split at ASCII white space, and how many each text has."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_binary()).cast(pa.large_string()))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    kept = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))]
    return flat.filter(real), kept[ends] - kept[ends - sizes]


def read_words(texts: pa.Array, fold: Callable[[bytes], bytes] = bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, after ``fold``."""
    flat, lengths = words_in(texts)
    coded = flat.dictionary_encode()
    digest, words = xxhash.xxh64_intdigest, coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter((digest(fold(w)) for w in words), np.uint64, len(words))
    return hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.uint64), lengths


def kind(window: int = WINDOW_WORDS) -> repeats.Kind:
    return repeats.Kind(window, max(1, 2 * window // 5), read_words, lambda h: h)


class Bits:
    """A bit vector, packed, with the number of ones before each block of 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.r_[bits, np.zeros(64 - len(bits) % 64, bool)], bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before place i."""
        block = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & below)


class Wavelet:
    """Ranks of any symbol in a sequence of small numbers: a wavelet matrix."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = []
        for level in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bits = (symbols >> level & 1).astype(bool)
            self.levels.append((level, Bits(bits), int(len(bits) - bits.sum())))
            symbols = np.r_[symbols[~bits], symbols[bits]]
        self.first = np.zeros(n_symbols, np.int64)
        self.first = self.walk(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where(symbol >> level & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place ``at``."""
        return self.walk(symbol, at) - self.first[symbol]


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling, until all suffixes differ."""
    ranks = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    done = 1
    while True:
        after = np.zeros_like(ranks)
        after[:-done] = ranks[done:] + 1
        both = (ranks << 32) | after
        order = np.argsort(both, kind="stable")
        steps = np.diff(both[order]) != 0
        ranks = np.empty_like(ranks)
        ranks[order] = np.r_[0, np.cumsum(steps)]
        if steps.all() or done >= len(symbols):
            return order
        done *= 2


class FMIndex:
    """Finds of word sequences in some phrases (arrays of symbols from 1)."""

    def __init__(self, text: np.ndarray, ends: np.ndarray, n_symbols: int):
        """``text``: phrases, each followed by a zero at one of ``ends``."""
        # Every end is an own symbol while sorting: no suffix is compared beyond its phrase.
        distinct = text + len(ends)
        distinct[ends] = np.arange(len(ends))
        self.order = suffix_array(distinct)
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=n_symbols))]
        self.transform = Wavelet(text[self.order - 1], n_symbols)
        self.size = len(text)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the matches with one more symbol in front."""
        base = self.before[symbol]
        return base + self.transform.rank(symbol, low), base + self.transform.rank(symbol, high)


def compare(window: int):
    """The windows of a shard's phrases that an earlier place has too."""

    def run(table: pa.Table) -> pa.Table:
        # In order of place: then a smaller place in the index is an earlier one.
        order = [("id", "ascending"), ("key", "ascending"), ("start", "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=order, null_placement="at_start"))
        units = [np.frombuffer(u, np.uint64) for u in table.column("units").to_pylist()]
        sizes = np.array([len(u) for u in units])
        vocabulary, words = np.unique(np.concatenate(units), return_inverse=True)
        begin = np.cumsum(sizes + 1) - sizes - 1
        text = np.zeros(int((sizes + 1).sum()), np.int64)
        owner_of = np.repeat(np.arange(len(units)), sizes)
        inside = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        text[begin[owner_of] + inside] = words + 1
        index = FMIndex(text, begin + sizes, len(vocabulary) + 1)

        count = table.column("n").to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(units)), count)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        at = begin[owner] + offset
        lane = np.arange(len(owner))
        low, high = np.zeros(len(owner), np.int64), np.full(len(owner), index.size)
        for step in range(window - 1, -1, -1):
            low, high = index.extend(text[at[lane] + step], low, high)
            more = high - low > 1
            lane, low, high = lane[more], low[more], high[more]
        if not len(lane):
            return repeats.stretches(table, lane, lane)
        # The earliest place of every interval; intervals of full length are equal or apart.
        sets, which = np.unique(low, return_inverse=True)
        tops = np.zeros(len(sets), np.int64)
        tops[which] = high
        cuts = np.stack([sets, tops], 1).ravel()
        first = np.minimum.reduceat(np.r_[index.order, index.size], cuts)[::2]
        later = first[which] < at[lane]
        mine = lane[later]
        return repeats.stretches(table, owner[mine], offset[mine])

    return run


def without_repeats(
    docs: DataFrame, window: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row's ``id``, word counts, and ``kept``: the words that no repeated window covers, space-joined."""
    rows = repeats.removed_runs(docs, kind(window), compare(window), True, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in repeats.slices(batch):
                size, gone, kept = [], [], []
                for text, runs in zip(part.column("text").to_pylist(), part.column("runs").to_pylist()):
                    words = text.split()
                    stay = left(words, runs or [])
                    size.append(len(words))
                    gone.append(len(words) - len(stay))
                    kept.append(b" ".join(stay))
                columns = [pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())]
                names = ["id", "n_words", "n_removed", "kept"]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names)

    longs = [T.StructField(n, T.LongType()) for n in ("n_words", "n_removed")]
    return mapped(rows, run, T.StructType([rows.schema["id"], *longs, T.StructField("kept", T.BinaryType())]))


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the windows of 20 words that occur earlier."""
    rows = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
