"""Removal of repeated byte strings, by prefix-free parsing.

Triggers found with a rolling hash cut the texts into overlapping phrases (see ``repeats``): every
string of ``WINDOW_BYTES`` lies in one phrase, and equal strings lie at the same distance from
the same trigger. The parse is the phrase of every place; the dictionary holds each phrase once.
Places with equal phrases are equal in corpus order without looking at a byte. Only different
phrases around one trigger are ordered by their content: a suffix array of a shard's part of the
dictionary, by prefix doubling, to the depth of a window. Corpus order is only asked for which
windows are equal, so order beyond that depth, and between triggers, is never made.

Defined cases: null texts are empty, texts shorter than a window lose nothing, matches never cross
documents. Every row is a document of its own: rows that repeat a text repeat all its strings, whatever
their ids, null ids included. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import mapped
from tidemark.llm import repeats

WINDOW_BYTES = 200
GRAM_BYTES = 100
BYTE_HASHES = repeats.scrambled(np.arange(1, 257, dtype=np.uint64) * repeats.ODD)


def read_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    values = texts.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8), np.fromiter(map(len, values), np.int64, len(values))


def kind(window: int = WINDOW_BYTES) -> repeats.Kind:
    return repeats.Kind(window, window // 2, read_bytes, lambda b: BYTE_HASHES[b])


def suffix_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix by its first ``depth`` bytes; equal ones share a rank."""
    done = 1
    ranks = data.astype(np.int64) + 1
    while done < depth:
        step = min(done, depth - done)
        after = np.zeros_like(ranks)
        after[:-step] = ranks[step:]
        ranks = np.unique((ranks << 32) | after, return_inverse=True)[1]
        ranks += 1
        done += step
    return ranks


def compare(window: int):
    """The windows that two or more phrases of a shard share."""

    def run(table: pa.Table) -> pa.Table:
        units = table.column("units").to_pylist()
        data = np.frombuffer(b"".join(units), np.uint8)
        count = table.column("n").to_numpy().astype(np.int64)
        begin = np.cumsum([0, *map(len, units)])[:-1]
        owner = np.repeat(np.arange(len(units)), count)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        ranks = suffix_ranks(data, window)[begin[owner] + offset]
        # A phrase never holds one window twice, as its trigger has one place in a window.
        shared = np.bincount(ranks)[ranks] > 1
        return repeats.stretches(table, owner[shared], offset[shared])

    return run


def without_repeats(
    docs: DataFrame, window: int = WINDOW_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row's ``id``, sizes, and ``kept``: its bytes without any that a repeated string covers."""
    rows = repeats.removed_runs(docs, kind(window), compare(window), False, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in repeats.slices(batch):
                texts, runs = part.column("text").to_pylist(), part.column("runs").to_pylist()
                kept = [left(t, r or []) for t, r in zip(texts, runs)]
                size, spans = [len(t) for t in texts], [len(r or []) for r in runs]
                gone = [n - len(k) for n, k in zip(size, kept)]
                columns = [pa.array(c, pa.int64()) for c in (size, gone, spans)] + [pa.array(kept, pa.binary())]
                names = ["id", "n_bytes", "n_removed", "n_spans", "kept"]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names)

    longs = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    return mapped(rows, run, T.StructType([rows.schema["id"], *longs, T.StructField("kept", T.BinaryType())]))


def left(units, runs: list[dict]):
    """What stays of a sequence without some ascending runs."""
    at, rest = 0, units[:0]
    for run in runs:
        rest += units[at : run["start"]]
        at = run["stop"]
    return rest + units[at:]


def op4_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without their repeated strings of 200 bytes."""
    rows = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
