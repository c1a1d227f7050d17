"""Fill-in-the-middle: texts cut into prefix, middle and suffix at unit boundaries, and put in another order.

Units are lines. A Fenwick tree over fixed blocks of a text holds how many units end and how many code points begin
in each. A cut after so many units descends the tree to its block, adding up code points on the way; the boundary
and the code points before it are then found within that block alone.

Defined cases: a null text is an empty one and stays plain, as do texts that contain a sentinel. A null id draws as
an empty number. Rows of one id are cut by the same draw. Texts may be of any length; only one block at a time is
looked at beyond the counts. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import mapped

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 7
RATE = 100  # percent of the texts that are transformed
SPM = 50  # percent of those that begin with the suffix
BLOCK = 4096  # bytes
OUT_BYTES = 8 << 20  # of texts that a batch hands on


class Fenwick:
    """Counts per block, with sums of the first blocks in a logarithmic number of steps."""

    def __init__(self, counts: np.ndarray) -> None:
        size = len(counts)
        total = np.concatenate([[0], np.cumsum(counts)])
        ends = np.arange(1, size + 1)
        # Node i holds the blocks from i minus its lowest bit up to i.
        self.nodes = [0, *(total[ends] - total[ends - (ends & -ends)]).tolist()]
        self.top = 1 << size.bit_length() >> 1

    def descend(self, target: int) -> tuple[int, int]:
        """The block in which the count reaches ``target`` (1 or more), and the count before that block."""
        at, before, step = 0, 0, self.top
        while step:
            if at + step < len(self.nodes) and before + self.nodes[at + step] < target:
                at += step
                before += self.nodes[at]
            step >>= 1
        return at, before

    def before(self, block: int) -> int:
        total = 0
        while block:
            total += self.nodes[block]
            block &= block - 1
        return total


class Units:
    """The lines of a text and where they end."""

    def __init__(self, text: bytes, block: int = BLOCK) -> None:
        self.text, self.block = text, block
        data = np.frombuffer(text, np.uint8)
        starts = np.arange(0, len(data), block)
        ends, points = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(data):
            ends = np.add.reduceat(data == 10, starts, dtype=np.int64)
            points = np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64)
            ends[-1] += not text.endswith(b"\n")  # the last line ends with the text
        self.n, self.points = int(ends.sum()), int(points.sum())
        self.ends, self.chars = Fenwick(ends), Fenwick(points)

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` lines."""
        if not units:
            return 0, 0
        if units >= self.n:
            return len(self.text), self.points
        block, before = self.ends.descend(units)
        begin = at = block * self.block
        for _ in range(units - before):
            at = self.text.index(b"\n", at) + 1
        here = np.frombuffer(self.text, np.uint8, at - begin, begin)
        return at, self.chars.before(block) + int(((here & 0xC0) != 0x80).sum())


def draws(key: int | str | None, seed: int) -> list[int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(text: bytes, key: int | str | None, seed: int = SEED, rate: int = RATE, spm: int = SPM, block: int = BLOCK):
    """(units, form, code points of prefix and middle, output bytes)."""
    units = Units(text, block)
    first, second, third, fourth = draws(key, seed)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or third % 100 >= rate:
        return units.n, "plain", None, None, text
    low, high = sorted((first % (units.n + 1), second % (units.n + 1)))
    (a, a_chars), (b, b_chars) = units.cut(low), units.cut(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    form = "spm" if fourth % 100 < spm else "psm"
    parts = (SUFFIX, suffix, PREFIX, prefix) if form == "spm" else (PREFIX, prefix, SUFFIX, suffix)
    return units.n, form, a_chars, b_chars - a_chars, b"".join((*parts, MIDDLE, middle))


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text of every row."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.col(id_col).alias("id"), text)
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def packed(ids: list, cut: list[tuple]) -> pa.RecordBatch:
        n, form, prefix, middle, output = zip(*cut)
        columns = [
            pa.concat_arrays(ids), pa.array(n, pa.int64()), pa.array(form, pa.string()),
            pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string()),
        ]
        return pa.record_batch(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cut, size = [], [], 0
            for at, (key, text) in enumerate(zip(batch.column("id"), batch.column("text"))):
                cut.append(transform(text.as_py(), key.as_py(), seed, rate, spm))
                ids.append(batch.column("id").slice(at, 1))
                size += len(cut[-1][4])
                if size >= OUT_BYTES:
                    yield packed(ids, cut)
                    ids, cut, size = [], [], 0
            if cut:
                yield packed(ids, cut)

    fields = "n long, form string, prefix_chars long, middle_chars long, output string"
    return mapped(rows, run, T.StructType([rows.schema["id"], *T.StructType.fromDDL(fields)]))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of. Every sentinel occurs once in it, as no text that has one is cut."""
    parts = F.split(F.col(output), f"{PREFIX.decode()}|{SUFFIX.decode()}|{MIDDLE.decode()}", -1)
    part = lambda i: F.get(parts, F.lit(i))
    return (
        F.when(F.col(form) == "plain", F.col(output))
        .when(F.col(form) == "psm", F.concat(part(1), part(3), part(2)))
        .otherwise(F.concat(part(2), part(3), part(1)))
    )


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """All documents with their cuts, and digests of the output and of the text rebuilt from it."""
    rows = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"),
    )


def _fim_sql() -> str:
    """By splitting at line feeds and joining the parts again."""
    draw = lambda i: f"CAST('0x' || substr(digest, {8 * i + 1}, 8) AS BIGINT)"
    upto = lambda k: (
        f"CASE WHEN {k} = 0 THEN '' WHEN {k} = n THEN body ELSE array_to_string(parts[1:{k}], chr(10)) || chr(10) END"
    )
    return f"""SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(body) AS restored_sha256
FROM (SELECT *, substr(upto, length(prefix) + 1) AS middle, substr(body, length(upto) + 1) AS suffix
FROM (SELECT *, {upto('low')} AS prefix, {upto('high')} AS upto
FROM (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
        OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form
FROM (SELECT *, {draw(0)} AS h1, {draw(1)} AS h2, {draw(2)} AS h3, {draw(3)} AS h4,
    CAST(len(parts) - CASE WHEN body = '' OR ends_with(body, chr(10)) THEN 1 ELSE 0 END AS BIGINT) AS n
FROM (SELECT doc_id, coalesce(text, '') AS body, string_split(coalesce(text, ''), chr(10)) AS parts,
    sha256('{SEED}:' || doc_id) AS digest FROM documents)))))"""


FILL_IN_MIDDLE_SQL = _fim_sql()
