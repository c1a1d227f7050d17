"""Benchmark decontamination: SimHash of item-sized windows, a Hamming block index, exact verification.

A document is searched for windows as long as an item (or the whole document, if it is shorter).
Windows without any shingle of an item of that length have similarity zero and are not looked at, which
loses nothing. The SimHash of every other window is looked up in the index: ``BLOCKS`` blocks of
the fingerprint, each with all values within ``BLOCK_FLIPS`` bits, so by the pigeonhole principle
no fingerprint within ``MAX_DISTANCE`` bits is missed. What lies within that distance is verified by
the exact similarity of the shingles, weighted by how often each occurs.

Benchmarks are small, but their size is checked: beyond ``BENCHMARK_BYTES`` they are taken in
parts by hash, a pass over the documents for each. Documents are never moved or paired.

Defined cases: words are lower-cased (A to Z) and split at ASCII white space. Items with fewer words than
a shingle match as a whole; empty and null ones never do, and null or empty documents contain nothing.
Of several windows that match an item the most similar is reported, of equal ones the first.
Repeated rows and items each give their own results. Empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import mapped, row_key, without_rows
from tidemark.llm.repeats import Rolling, slices
from tidemark.llm.word_repeats import read_words
from tidemark.session import materialized

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
BLOCKS = 8
BLOCK_FLIPS = 2
MAX_DISTANCE = BLOCKS * (BLOCK_FLIPS + 1) - 1
BENCHMARK_BYTES = 16 << 20
RUN = 1 << 12  # windows fingerprinted at once
FILTER_BITS = 20


def lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, in lower case, and how many each text has."""
    return read_words(texts, bytes.lower)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    return Rolling(words).every(size) if len(words) >= size else np.zeros(0, np.uint64)


def fingerprints(hashes: np.ndarray, length: int) -> np.ndarray:
    """SimHash of every window of ``length`` neighbours."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    most = 2 * (sums[length:] - sums[:-length]) > length
    return np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shared shingles over all, each as often as it occurs."""
    one, two = Counter(a.tolist()), Counter(b.tolist())
    shared = (one & two).total()
    return shared / (len(a) + len(b) - shared)


NEAR = [sum(1 << b for b in flip) for n in range(BLOCK_FLIPS + 1) for flip in combinations(range(8), n)]


class Items:
    """The items of one length: their shingles and the block index of their fingerprints."""

    def __init__(self, numbers: list[int], words: list[np.ndarray], size: int):
        self.numbers, self.size, self.length = numbers, size, len(words[0])
        self.shingles = [shingles(w, size) for w in words]
        self.prints = np.concatenate([fingerprints(s, len(s)) for s in self.shingles])
        # near[block, value, item]: whether the item's block is within the flips of the value.
        self.near = np.zeros((BLOCKS, 256, len(words)), bool)
        values = self.prints.view(np.uint8).reshape(-1, BLOCKS)
        for flip in NEAR:
            for block in range(BLOCKS):
                self.near[block, values[:, block] ^ flip, np.arange(len(words))] = True

    def candidates(self, prints: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, item and distance of all pairs within ``max_distance`` bits."""
        values = prints.view(np.uint8).reshape(-1, BLOCKS)
        found = self.near[0, values[:, 0]]
        for block in range(1, BLOCKS):
            found = found | self.near[block, values[:, block]]
        window, item = np.nonzero(found)
        distance = np.bitwise_count(prints[window] ^ self.prints[item])
        close = distance <= max_distance
        return window[close], item[close], distance[close]


class Index:
    """All items, ready to be searched for in documents."""

    def __init__(self, texts: list[bytes]):
        words, lengths = lowered(pa.array(texts, pa.binary()))
        each = np.split(words, np.cumsum(lengths)[:-1]) if texts else []
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, w in enumerate(each):
            if len(w):
                by_length[len(w)].append(i)
        self.groups = [Items(ids, [each[i] for i in ids], min(SHINGLE_WORDS, n)) for n, ids in sorted(by_length.items())]
        self.sizes = sorted({g.size for g in self.groups})
        self.known, self.maybe = {}, {}
        for size in self.sizes:
            hashes = np.unique(np.concatenate([s for g in self.groups if g.size == size for s in g.shingles]))
            self.known[size] = hashes
            self.maybe[size] = np.zeros(1 << FILTER_BITS, bool)
            self.maybe[size][hashes >> np.uint64(64 - FILTER_BITS)] = True
        # The lengths of items that have a shingle.
        self.lengths: dict[tuple[int, int], set[int]] = defaultdict(set)
        for k, group in enumerate(self.groups):
            for h in {h for s in group.shingles for h in s.tolist()}:
                self.lengths[group.size, h].add(k)

    def hits(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of items' shingles in a row of words, and the shingles."""
        hashes = shingles(words, size)
        at = np.flatnonzero(self.maybe[size][hashes >> np.uint64(64 - FILTER_BITS)])
        place = np.searchsorted(self.known[size], hashes[at])
        at = at[self.known[size][np.minimum(place, len(self.known[size]) - 1)] == hashes[at]]
        return at, hashes

    def search(self, words: np.ndarray, size: int, at: np.ndarray, hashes: np.ndarray, least: float, radius: int) -> dict:
        """Best match of every item of this shingle size in one document, given the places of shingles."""
        wanted: dict[int, list[int]] = defaultdict(list)
        for p in at.tolist():
            for k in self.lengths[size, int(hashes[p])]:
                wanted[k].append(p)
        best: dict[int, tuple] = {}
        for k, places in wanted.items():
            group = self.groups[k]
            span = min(group.length, len(words)) - size + 1
            marked = np.zeros(len(hashes) - span + 2, np.int32)
            for p in places:
                marked[max(0, min(p - span + 1, len(marked) - 2))] += 1
                marked[min(p, len(marked) - 2) + 1] -= 1
            starts = np.flatnonzero(np.cumsum(marked)[:-1] > 0)
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                for a in range(int(run[0]), int(run[-1]) + 1, RUN):
                    b = min(int(run[-1]) + 1, a + RUN)
                    prints = fingerprints(hashes[a : b - 1 + span], span)
                    for w, i, d in zip(*(x.tolist() for x in group.candidates(prints, radius))):
                        found = similarity(hashes[a + w : a + w + span], group.shingles[i])
                        if found >= least:
                            match = (-found, a + w, d, span + size - 1)
                            best[group.numbers[i]] = min(best.get(group.numbers[i], match), match)
        return best


INDEXES: dict[str, Index] = {}


def index_of(texts: list[bytes]) -> Index:
    name = hashlib.sha256(pickle.dumps(texts)).hexdigest()
    if name not in INDEXES:
        INDEXES.clear()
        INDEXES[name] = Index(texts)
    return INDEXES[name]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    min_similarity: float = MIN_SIMILARITY,
    max_distance: int = MAX_DISTANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id``, ``key``, ``item_id``, ``start_word``, ``n_words``, ``similarity``, ``distance`` of every match."""
    size = benchmark.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    parts = 1 + size // BENCHMARK_BYTES
    part_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    by_part = (
        matches(docs, benchmark.filter(part_of == i), min_similarity, max_distance, id_col, text_col) for i in range(parts)
    )
    # Of several parts each is matched and written before the driver fetches the next.
    found = by_part if parts == 1 else (materialized(part, "matches") for part in by_part)
    out = next(found)
    for more in found:
        out = out.unionByName(more)
    return out


def matches(
    docs: DataFrame, benchmark: DataFrame, min_similarity: float, max_distance: int, id_col: str, text_col: str
) -> DataFrame:
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError(f"the block index is complete up to {MAX_DISTANCE} bits")
    # Of checked size, see above.
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).collect()
    texts, names = [bytes(r["text"]) for r in items], [r["item_id"] for r in items]
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of(texts)
        for batch in batches:
            for part in slices(batch):
                words, lengths = lowered(part.column("text"))
                ends = np.cumsum(lengths)
                begin = ends - lengths
                out = []
                for size in index.sizes:
                    at, hashes = index.hits(words, size)
                    doc = np.searchsorted(ends, at, "right")
                    inside = at + size <= ends[doc]
                    at, doc = at[inside], doc[inside]
                    cuts = np.flatnonzero(np.diff(doc)) + 1
                    for places, i in zip(np.split(at, cuts), doc[np.r_[0, cuts]].tolist() if len(doc) else []):
                        a, b = int(begin[i]), int(ends[i])
                        best = index.search(
                            words[a:b], size, places - a, hashes[a : b - size + 1], min_similarity, max_distance
                        )
                        out += [(i, names[n], start, many, -s, d) for n, (s, start, d, many) in sorted(best.items())]
                who, *rest = zip(*out) if out else [[]] * 6
                columns = [part.column("id").take(pa.array(who, pa.int64())), part.column("key").take(pa.array(who, pa.int64()))]
                types = [item_type, pa.int64(), pa.int64(), pa.float64(), pa.int64()]
                columns += [pa.array(c, t) for c, t in zip(rest, types)]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    item_field = T.StructField("item_id", benchmark.schema["item_id"].dataType)
    longs = [T.StructField(n, T.LongType()) for n in ("start_word", "n_words")]
    last = [T.StructField("similarity", T.DoubleType()), T.StructField("distance", T.LongType())]
    schema = T.StructType([rows.schema["id"], T.StructField("key", T.LongType()), item_field, *longs, *last])
    item_type = to_arrow_type(item_field.dataType)
    return mapped(rows, run, schema)


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that contain an item."""
    found = contamination(docs, benchmark, id_col=id_col, text_col=text_col)
    unwanted = found.select(F.col("key").alias("_key"), F.col("id").alias("_id")).distinct()
    return without_rows(docs, materialized(unwanted, "contaminated"), row_key(id_col, text_col), id_col)


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """All pairs of a document and an item it contains."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("key").withColumnRenamed("id", "doc_id")
