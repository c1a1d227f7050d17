"""Token ids in Huffman-coded files.

Texts become ids with a public tokenizer; ids are counted over the whole corpus; the counts give one
canonical, length-limited Huffman code, whose code lengths (one small number per id of the vocabulary)
are all that is needed to read. The files are written through Spark, in ascending id order of the
documents: parts in order, blocks in order within a part. A block holds whole documents and can be read
alone: their ids and token counts, the code bits, and the bit offset of every 64th token. Reading
decodes a block from all its offsets at once, a token a step, each with one table look-up.

Defined cases: a null text is empty and has the end id alone. Rows with one document id keep some
fixed order among themselves, and null ids come first. An empty table gives empty files.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import mapped
from tidemark.llm.repeats import slices
from tidemark.session import materialized, scratch_dir

END_ID = 0
MAX_CODE_BITS = 18
BLOCK_TOKENS = 1 << 18
CHECKPOINT = 64
CACHED_PIECES = 800_000
SLICE_BYTES = 12 << 20  # of text looked at in one go
JOINED = 500  # pieces encoded as one text


class Encoder:
    """Ids of texts, as the tokenizers library gives them for a byte-level vocabulary.

    Byte-level pre-tokenization never joins a character and the white space after it, so a text
    may be cut there. Pieces between single spaces recur, and each is encoded once, the words on both
    sides of a line end apart; the few texts with a space after other white space go to the library whole.
    """

    after_space = r"[\s\pZ\x0b\x1c-\x1f\x{85}] "
    space_at_end = r"[\s\pZ\x0b\x1c-\x1f\x{85}]$"
    # The first line end that does not follow other white space.
    line_end = r"^(?P<head>(?s:.*?)[^\s\pZ\x0b\x1c-\x1f\x{85}])(?P<tail>(?s:\n.*))$"
    # Marks after such a letter begin a token of their own, unless a special string has them.
    letter = r"[A-Za-z\x{e0}-\x{f6}\x{f8}-\x{ff}]"
    marks = "!?;:#$%&*"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        # How many bytes of text each id stands for.
        words = self.tokenizer.get_vocab(with_added_tokens=False)
        self.width = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for word, i in words.items():
            self.width[i] = len(word)
        special = {i: added.content for i, added in self.tokenizer.get_added_tokens_decoder().items()}
        for i, content in special.items():
            self.width[i] = len(content.encode())
        self.marks = ".," + "".join(c for c in self.marks if not any(c in content for content in special.values()))
        self.stop = f"{self.letter}[{self.marks}]+$"
        self.planes = 2 if len(self.width) <= 1 << 16 else 4
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.lengths = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)
        self.again = np.zeros(0, np.int32)

    def forget_rare(self) -> None:
        """Keeps the pieces that came again in the slice looked at last."""
        came = np.zeros(len(self.lengths), bool)
        came[self.again] = True
        kept = [(name, at) for name, at in self.number.items() if came[at]]
        at = np.array([at for _, at in kept], np.int64)
        first = (np.cumsum(self.lengths) - self.lengths)[at]
        lengths = self.lengths[at]
        within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        ids = self.ids[np.repeat(first, lengths) + within]
        self.forget()
        self.number, self.lengths, self.ids = {name: i for i, (name, _) in enumerate(kept)}, lengths, ids

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def library(self, joined: list[str], alone: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has, and all ids in a row.

        The pieces of ``joined`` begin with a space or a line end and end without white space, and are encoded
        many in one text: the widths of the ids tell where each ends.
        """
        texts = ["".join(joined[k : k + JOINED]) for k in range(0, len(joined), JOINED)]
        # A few at a time: what the library returns is much larger than the ids.
        got = [ids for k in range(0, len(texts), 16) for ids in self.ids_of(texts[k : k + 16])]
        flat = np.concatenate([np.zeros(0, np.uint32), *got])
        ends = np.cumsum(pc.binary_length(pa.array(joined, pa.string())).to_numpy().astype(np.int64))
        stops = np.searchsorted(np.cumsum(self.width[flat]), ends) + 1
        rest = self.ids_of(alone)
        counts = np.r_[np.diff(np.r_[0, stops]), np.fromiter(map(len, rest), np.int64, len(rest))].astype(np.int32)
        return counts, np.concatenate([flat, *rest])

    def places(self, names: pa.Array) -> np.ndarray:
        """Where some pieces are in the cache; new ones are encoded, also one that comes twice."""
        pieces = names.to_pylist()
        at = np.fromiter(map(self.number.get, pieces, repeat(-1)), np.int32, len(pieces))
        self.again = at[at >= 0]
        new = np.flatnonzero(at < 0)
        begins = pc.or_(pc.starts_with(names, " "), pc.starts_with(names, "\n"))
        joins = pc.and_not(begins, pc.match_substring_regex(names, self.space_at_end))
        single = ~joins.to_numpy(zero_copy_only=False)[new]
        new = np.r_[new[~single], new[single]]
        names = [pieces[i] for i in new.tolist()]
        begin, many = len(self.lengths), len(names) - int(single.sum())
        self.number.update(zip(names, range(begin, begin + len(names))))
        lengths, ids = self.library(names[:many], names[many:])
        self.lengths, self.ids = np.r_[self.lengths, lengths], np.r_[self.ids, ids]
        at[new] = np.arange(begin, begin + len(names))
        return at

    def numbered(self, names: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The distinct names, and the number of each name among them; -1 for none."""
        coded = names.dictionary_encode()
        return coded.dictionary, pc.fill_null(coded.indices, -1).to_numpy()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts (none null) in a row, and how many each text has."""
        if len(self.number) > CACHED_PIECES:
            self.forget_rare()
        whole = pc.match_substring_regex(texts, self.after_space).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(whole), "", texts) if whole.any() else texts, " ")
        flat = lists.flatten()
        count = pc.list_value_length(lists).to_numpy()
        first = np.cumsum(count) - count
        coded = flat.dictionary_encode()
        code = coded.indices.to_numpy().copy()
        # All pieces but a text's first have their space back; what follows a line end, and marks, apart.
        begins = flat.take(pa.array(first)).dictionary_encode()
        spaced = pc.binary_join_element_wise(" ", coded.dictionary, "").cast(pa.string())
        code[first] = begins.indices.to_numpy() + len(spaced)
        pieces = pa.concat_arrays([spaced, begins.dictionary.cast(pa.string())])
        cut = pc.extract_regex(pc.if_else(pc.match_substring(pieces, "\n"), pieces, None), self.line_end)
        tails, tail = self.numbered(pc.struct_field(cut, "tail"))
        heads = pc.coalesce(pc.struct_field(cut, "head"), pieces)
        stopped = pc.match_substring_regex(heads.slice(0, len(spaced)), self.stop)
        stopped = pa.concat_arrays([stopped, pa.array(np.zeros(len(begins.dictionary), bool))])
        ends = pc.replace_substring_regex(pc.if_else(stopped, heads, None), f"^(?s:.*?)([{self.marks}]+)$", r"\1")
        stops, stop = self.numbered(ends)
        bases, base = self.numbered(pc.if_else(stopped, pc.utf8_rtrim(heads, self.marks), heads))
        at = self.places(pa.concat_arrays([bases, stops, tails]))
        parts = (1 + (stop >= 0) + (tail >= 0)).astype(np.int32)
        last = np.cumsum(parts[code], dtype=np.int32) - 1
        places = np.empty(int(last[-1]) + 1 if len(last) else 0, np.int32)
        places[last - (parts - 1)[code]] = at[base][code]
        # A stop lies before the tail, if there is one.
        for which, after, offset in ((stop, tail >= 0, len(bases)), (tail, tail < -1, len(bases) + len(stops))):
            has = np.flatnonzero((which >= 0)[code])
            own = code[has]
            places[last[has] - after[own]] = at[offset + which[own]]

        lengths = self.lengths[places]
        begin = (np.cumsum(self.lengths, dtype=np.int32) - self.lengths)[places]
        ends = np.cumsum(lengths, dtype=np.int32)
        within = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32)
        ids = self.ids[np.repeat(begin - (ends - lengths), lengths) + within]
        counts = np.diff(np.r_[0, ends[last[np.cumsum(count) - 1]]])
        if not whole.any():
            return ids, counts
        each = np.split(ids, np.cumsum(counts)[:-1])
        for i in np.flatnonzero(whole):
            each[i] = self.ids_of([texts[i].as_py()])[0]
        return np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))


ENCODERS: dict[str, Encoder] = {}


def encoded(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``row`` and the packed ids of every row with the end id; written, since several passes read them.

    Every task adds a row with its counts of the ids (``seen``), so that they need not be unpacked for it.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ENCODERS.get(path) or ENCODERS.setdefault(path, Encoder(path))
        seen = np.zeros(max(len(encoder.width), end_id + 1), np.int64)
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch, size=SLICE_BYTES):
                ids, counts = encoder.encode(part.column("text"))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)
                seen += np.bincount(ids, minlength=len(seen))
                planes = [(ids >> np.uint32(8 * k)).astype(np.uint8).tobytes() for k in range(encoder.planes)]
                ends = (ends + np.arange(1, len(ends) + 1)).tolist()
                head = bytes([encoder.planes])
                packed = [
                    head + packer.compress(b"".join([p[a:b] for p in planes])) for a, b in zip([0, *ends], ends)
                ]
                none = pa.nulls(part.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("row"), pa.array(packed, pa.binary()), none], names
                )
        # The task's last row has no document: how often it has seen each id.
        last = [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())]
        yield pa.RecordBatch.from_arrays([*last, pa.array([seen.astype("<i8").tobytes()], pa.binary())], names)

    binary = [T.StructField(n, T.BinaryType()) for n in ("packed", "seen")]
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("row", T.LongType()), *binary])
    names, id_type = schema.names, to_arrow_type(schema["id"].dataType)
    return materialized(mapped(rows, run, schema), "token-ids")


def unpacked(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Packed ids are byte planes, which compress better, after a byte for their number."""
    reader, out = zstandard.ZstdDecompressor(), []
    for packed in batch.column("packed").to_pylist():
        planes = np.frombuffer(reader.decompress(memoryview(packed)[1:]), np.uint8).reshape(packed[0], -1)
        ids = planes[0].astype(np.uint32)
        for k in range(1, packed[0]):
            ids |= planes[k].astype(np.uint32) << np.uint32(8 * k)
        out.append(ids)
    return out


def counted(ids: DataFrame) -> dict[int, int]:
    """How often each id occurs in the corpus: one number for each id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seen in batch.column("seen").to_pylist():
                counts = np.frombuffer(seen, "<i8")
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["token", "n"])

    seen = ids.select("seen").filter("seen is not null")
    total = mapped(seen, run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: r["n"] for r in total.collect()}


def code_lengths(counts: dict[int, int], most: int = MAX_CODE_BITS) -> dict[int, int]:
    """Optimal code lengths of at most ``most`` bits: package-merge."""
    ids = sorted(counts, key=lambda i: (counts[i], i))
    n = len(ids)
    if n < 2:
        return dict.fromkeys(ids, 1)
    if n > 1 << most:
        raise ValueError(f"{n} ids need more than {most} bits")
    leaves = np.array([counts[i] for i in ids], np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(most):
        weights = np.concatenate([leaves, packages])
        order = np.argsort(weights, kind="stable")
        levels.append(order < n)
        merged = weights[order][: len(weights) // 2 * 2]
        packages = merged[0::2] + merged[1::2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    return dict(zip(ids, lengths.tolist()))


class Code:
    """The canonical code of some code lengths: shorter codes first, then smaller ids."""

    def __init__(self, lengths: dict[int, int]):
        order = sorted(lengths, key=lambda i: (lengths[i], i))
        size = np.array([lengths[i] for i in order], np.int64)
        self.bits = int(size[-1]) if order else 1
        # Codes as numbers of full width count up by what each leaves room for.
        room = np.left_shift(1, self.bits - size)
        first = np.cumsum(room) - room
        self.code = np.zeros(max(order, default=0) + 1, np.uint64)
        self.size = np.zeros(max(order, default=0) + 1, np.int64)
        self.code[order] = first >> (self.bits - size)
        self.size[order] = size
        self.table = np.zeros(1 << self.bits, np.uint32)
        self.table[: int(room.sum())] = np.repeat(np.array(order, np.uint32) << np.uint32(5) | size.astype(np.uint32), room)

    def write(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The code bits, first bit highest, and the bit offset of every CHECKPOINT-th id."""
        size, code = self.size[ids], self.code[ids]
        ends = np.cumsum(size)
        begin = ends - size
        word, over = begin >> 6, (begin & 63) + size - 64
        words = np.zeros(int(ends[-1]) // 64 + 2, np.uint64)
        up, down = np.maximum(-over, 0).astype(np.uint64), np.maximum(over, 0).astype(np.uint64)
        heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        words[word[heads]] = np.bitwise_or.reduceat((code << up) >> down, heads)
        split = np.flatnonzero(over > 0)
        words[word[split] + 1] |= code[split] << (64 - over[split]).astype(np.uint64)
        return words.astype(">u8").tobytes(), begin[::CHECKPOINT]

    def read(self, bits: bytes, offsets: np.ndarray, n: int) -> np.ndarray:
        words = np.frombuffer(bits, ">u8").astype(np.uint64)
        at = offsets.copy()
        out = np.zeros((len(at), CHECKPOINT), np.uint32)
        shift, one, last = np.uint64(64 - self.bits), np.uint64(1), np.uint64(63)
        end = (len(words) - 1) * 64
        for step in range(CHECKPOINT):
            word, inside = at >> 6, (at & 63).astype(np.uint64)
            seen = (words[word] << inside) | ((words[word + 1] >> one) >> (last - inside))
            entry = self.table[seen >> shift]
            out[:, step] = entry >> np.uint32(5)
            at = np.minimum(at + (entry & np.uint32(31)), end - 1)  # the last lane runs past its ids
        return out.ravel()[:n]


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """The ids of all rows in files below ``path``: ``blocks``, and ``lengths`` with the code."""
    ids = encoded(docs, vocabulary, end_id, id_col, text_col)
    lengths = code_lengths(counted(ids))
    ids = ids.filter("packed is not null")
    pairs = [(i, n) for i, n in sorted(lengths.items())]
    spark = docs.sparkSession
    spark.createDataFrame(pairs, "token long, bits int").coalesce(1).write.parquet(f"{path}/lengths")
    code = Code(lengths)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, names, size = TaskContext.get().partitionId(), 0, [], [], 0

        def block() -> pa.RecordBatch:
            bits, offsets = code.write(np.concatenate(held))
            steps = np.diff(offsets).astype("<u2")  # at most CHECKPOINT codes of MAX_CODE_BITS
            columns = [[part], [number], [names], [[len(h) for h in held]], [steps.tobytes()], [bits]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, arrow_types)], [f.name for f in fields]
            )

        for part_of in (p for batch in batches for p in slices(batch, "packed")):
            for name, one in zip(part_of.column("id").to_pylist(), unpacked(part_of)):
                held.append(one)
                names.append(name)
                size += len(one)
                if size >= BLOCK_TOKENS:
                    yield block()
                    number, held, names, size = number + 1, [], [], 0
        if held:
            yield block()

    id_type = ids.schema["id"].dataType
    fields = [
        T.StructField("part", T.LongType()),
        T.StructField("block", T.LongType()),
        T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("offsets", T.BinaryType()),
        T.StructField("bits", T.BinaryType()),
    ]
    arrow_types = [to_arrow_type(f.dataType) for f in fields]
    # Code bits do not compress.
    ordered = mapped(ids.orderBy("id", "row").select("id", "packed"), blocks, T.StructType(fields))
    ordered.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Per document of the files: ``id``, ``start``, ``n_tokens`` and ``tokens`` (little-endian 32-bit ids).

    With ``digest``, the CRC-32 of these bytes (``crc32``) in their place.
    """
    code = Code({r["token"]: r["bits"] for r in spark.read.parquet(f"{path}/lengths").collect()})
    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = blocks.select("part", "block", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
    sizes = materialized(sizes, "block-sizes")
    before = lambda order: order.rowsBetween(W.unboundedPreceding, -1)
    # One row a part in the one window without a key; blocks are summed within their part.
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", F.sum("n").over(before(W.partitionBy(F.lit(0)).orderBy("part"))).alias("first"))
    starts = sizes.withColumn("inside", F.sum("n").over(before(W.partitionBy("part").orderBy("block")))).join(parts, "part")
    zero = F.lit(0).cast("bigint")
    starts = starts.select("part", "block", (F.coalesce("first", zero) + F.coalesce("inside", zero)).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                counts = one.column("counts").flatten().to_numpy()
                steps = np.frombuffer(one.column("offsets")[0].as_py(), "<u2").astype(np.int64)
                offsets = np.r_[0, np.cumsum(steps)]
                ids = code.read(one.column("bits")[0].as_py(), offsets, int(counts.sum())).astype("<u4")
                ends = np.cumsum(counts)
                each = (ids[e - n : e].tobytes() for e, n in zip(ends, counts))
                tokens = pa.array(map(zlib.crc32, each), pa.int64()) if digest else pa.array(each, pa.binary())
                start = one.column("start")[0].as_py() + ends - counts
                columns = [one.column("ids").flatten(), pa.array(start), pa.array(counts), tokens]
                yield pa.RecordBatch.from_arrays(columns, ["id", "start", "n_tokens", "crc32" if digest else "tokens"])

    schema = T.StructType(
        [
            T.StructField("id", blocks.schema["ids"].dataType.elementType),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("crc32", T.LongType()) if digest else T.StructField("tokens", T.BinaryType()),
        ]
    )
    return mapped(blocks.join(starts, ["part", "block"]), run, schema)


def op5_token_id_output(spark, sf_dir: str) -> DataFrame:
    """All documents, written as ids and read back."""
    path = scratch_dir(spark, "token-files")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("byte_bpe_50k.json"))
    rows = read_tokens(spark, path, digest=True)
    return rows.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc32").alias("ids_crc32"))
