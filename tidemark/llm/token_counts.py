"""Token counts by a tokenizer compiled into a finite-state transducer.

A byte-pair vocabulary with word-end marks is compiled, as words come along, into a deterministic
transducer over bytes. The tokens of a prefix end in exactly one token that agrees with those before
it, so a state only has to remember where a longer token may still begin: for each such place the
token that ends there and how many tokens fewer it has. A transition says by how much the count
changes, the last one of a word how it ends. Words run through the tables together, a byte a step.

Words are what ASCII white space separates: no token of such a vocabulary reaches across it.
Long texts are cut into chunks of fixed size, also within words. A chunk's state map is constant after its
first white space, so it is what stands before that, the count inside, and what stands after the last
one; maps of neighbours compose, in pairs, pairs of pairs and so on.

Defined cases: null and empty texts have no tokens. Special strings count as the library counts
them by default. Rows are counted one by one: repeated rows and missing ids change nothing. An
empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import mapped
from tidemark.llm.repeats import slices

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
CHUNK_BYTES = 1 << 16
MOST_STATES = 1 << 18
CACHED_WORDS = 400_000
UNKNOWN = -128


class Transducer:
    """Counts tokens of words (bytes) by tables that grow with the words seen."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str, letters: list[str]):
        """``letters``: the character that stands for each byte in the vocabulary."""
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.end, self.letters = end, letters
        self.final = {v[: -len(end)] for v in vocabulary if v.endswith(end)}
        self.inner = {v for v in vocabulary if not v.endswith(end)}
        self.begun = {v[:k] for v in self.final | self.inner for k in range(len(v))}
        self.agree: dict[tuple[str, str, bool], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.column = np.full(256, -1, np.int16)
        self.bytes_seen: list[int] = []
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.next = np.full((1024, 32), -1, np.int32)
        self.gain = np.zeros((1024, 32), np.int8)
        self.close = np.full((1024, 32), UNKNOWN, np.int8)
        self.state("", ((0, None, 0),))

    def state(self, seen: str, places: tuple) -> int:
        """``places``: (bytes since, token that ends there, count there less the count here), longest first."""
        number = self.numbers.setdefault((seen, places), len(self.states))
        if number == len(self.states):
            self.states.append((seen, places))
            if number == len(self.next):
                self.grow((2 * number, self.next.shape[1]))
        return number

    def grow(self, shape: tuple[int, int]) -> None:
        for name, fill in (("next", -1), ("gain", 0), ("close", UNKNOWN)):
            old = getattr(self, name)
            new = np.full(shape, fill, old.dtype)
            new[: old.shape[0], : old.shape[1]] = old
            setattr(self, name, new)

    def agrees(self, before: str | None, token: str, last: bool) -> bool:
        """Whether merging puts the two tokens together from their characters just so."""
        if before is None:
            return True
        known = self.agree.get((before, token, last))
        if known is None:
            symbols = list(before + token)
            want = [before, token + self.end] if last else [before, token]
            if last:
                symbols[-1] += self.end
            known = self.agree[before, token, last] = self.merged(symbols) == want
        return known

    def merged(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            ranks = [self.rank.get(pair, len(self.rank)) for pair in zip(symbols, symbols[1:])]
            least = min(ranks)
            if least == len(self.rank):
                break
            a, b = symbols[ranks.index(least) :][:2]
            out, i = [], 0
            while i < len(symbols):
                both = symbols[i : i + 2] == [a, b]
                out.append(a + b if both else symbols[i])
                i += 2 if both else 1
            symbols = out
        return symbols

    def compile_step(self, state: int, column: int) -> None:
        seen, places = self.states[state]
        letter = self.letters[self.bytes_seen[column]]
        cut = {since: seen[len(seen) - since :] + letter for since, _, _ in places}
        token, less = next((cut[n], d) for n, t, d in places if cut[n] in self.inner and self.agrees(t, cut[n], False))
        gain = less + 1
        still = [(n + 1, t, d - gain) for n, t, d in places if cut[n] in self.begun] + [(0, token, 0)]
        longest = still[0][0]
        target = self.state((seen + letter)[len(seen) + 1 - longest :], tuple(still))
        self.next[state, column], self.gain[state, column] = target, gain

    def compile_end(self, state: int, column: int) -> None:
        seen, places = self.states[state]
        letter = self.letters[self.bytes_seen[column]]
        cuts = ((seen[len(seen) - n :] + letter, t, d) for n, t, d in places)
        self.close[state, column] = next(d + 1 for c, t, d in cuts if c in self.final and self.agrees(t, c, True))

    def looked_up(self, table: np.ndarray, name: str, missing: int, state, column, compiled) -> np.ndarray:
        found = table[state, column]
        absent = found == missing
        if absent.any():
            for key in np.unique(state[absent].astype(np.int64) << 8 | column[absent]):
                compiled(int(key) >> 8, int(key) & 255)
            found = getattr(self, name)[state, column]
        return found

    def counts(self, words: list[bytes]) -> np.ndarray:
        """How many tokens each word has; no word is empty."""
        if len(self.states) > MOST_STATES:
            self.forget()
        flat = np.frombuffer(b"".join(words), np.uint8)
        for byte in np.unique(flat[self.column[flat] < 0]).tolist():
            self.column[byte] = len(self.bytes_seen)
            self.bytes_seen.append(byte)
        if len(self.bytes_seen) > self.next.shape[1]:
            self.grow((len(self.next), 2 * len(self.bytes_seen)))
        columns = self.column[flat]
        length = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(length) - length
        total = np.zeros(len(words), np.int64)
        lane = np.argsort(-length, kind="stable")
        state, at = np.zeros(len(words), np.int32), 0
        while len(lane):
            column = columns[begin[lane] + at]
            over = length[lane] == at + 1
            total[lane[over]] += self.looked_up(self.close, "close", UNKNOWN, state[over], column[over], self.compile_end)
            lane, state, column = lane[~over], state[~over], column[~over]
            following = self.looked_up(self.next, "next", -1, state, column, self.compile_step)
            total[lane] += self.gain[state, column]
            state, at = following, at + 1
        return total


def byte_letters() -> list[str]:
    """Byte-level vocabularies write printable bytes as themselves and number the rest from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Counter:
    """Token counts of texts, as the tokenizers library has them for the word vocabulary."""

    # On lower-case ASCII what the vocabulary's own pattern finds.
    simple = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path) as file:
            described = json.load(file)
        self.special = [t["content"] for t in described["added_tokens"]]
        model = described["model"]
        vocabulary = {v: i for v, i in model["vocab"].items() if v not in self.special}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.transducer = Transducer(vocabulary, merges, model["end_of_word_suffix"], byte_letters())
        self.known: dict[str, int] = {}

    def pieces(self, word: str) -> list[bytes]:
        if word.isascii() and word.isprintable():
            return [p.encode() for p in self.simple.findall(word.lower())]
        normal = self.tokenizer.normalizer.normalize_str(word)
        return [normal[a:b].encode() for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def words(self, words: list[str]) -> np.ndarray:
        """Token counts of words without white space."""
        new = [w for w in words if w not in self.known]
        if new:
            if len(self.known) > CACHED_WORDS:
                self.known = {}
                new = words
            odd = [w for w in new if any(s in w for s in self.special)]
            self.known.update((w, len(self.tokenizer.encode(w, add_special_tokens=False).ids)) for w in odd)
            rest = [w for w in new if w not in self.known] if odd else new
            cut = [self.pieces(w) for w in rest]
            flat = [p for one in cut for p in one]
            distinct = list(dict.fromkeys(flat))
            counted = dict(zip(distinct, self.transducer.counts(distinct).tolist())) if distinct else {}
            self.known.update((w, sum(map(counted.__getitem__, one))) for w, one in zip(rest, cut))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def texts(self, texts: pa.Array) -> np.ndarray:
        """Token counts of texts (none null)."""
        chunks, owner = [], []
        for i, text in enumerate(texts):
            raw = text.as_buffer()
            parts = [texts[i].as_py()] if raw.size <= CHUNK_BYTES else cut(raw.to_pybytes())
            chunks += parts
            owner += [i] * len(parts)
        maps = self.maps(pa.array(chunks, pa.large_string()))
        owner = np.array(owner, np.int64)
        while len(owner) and (owner[1:] == owner[:-1]).any():
            owner, maps = self.composed(owner, maps)
        loose = [w for head, _, tail in maps for w in (head, tail or "") if w]
        known = iter(self.words(loose).tolist())
        return np.array([n + sum(next(known) for w in (h, t or "") if w) for h, n, t in maps], np.int64)

    def maps(self, chunks: pa.Array) -> list[tuple[str, int, str | None]]:
        """What stands before the first white space, the count after it, what stands after the last (None: no white space)."""
        lists = pc.ascii_split_whitespace(chunks)
        coded = lists.flatten().dictionary_encode()
        size = pc.list_value_length(lists).to_numpy()
        ends = np.cumsum(size)
        first, last = (ends - size), ends - 1
        distinct = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy()
        ends_only = np.zeros(len(code), bool)
        ends_only[first] = ends_only[last] = True
        inside = np.unique(code[~ends_only])
        count = np.zeros(len(distinct), np.int64)
        words = [distinct[i] for i in inside]
        if words and "" in words:
            inside = inside[[bool(w) for w in words]]
            words = [w for w in words if w]
        count[inside] = self.words(words)
        each = np.where(ends_only, 0, count[code])
        sums = np.r_[0, np.cumsum(each)]
        total = sums[ends] - sums[first]
        heads, tails = code[first], code[last]
        return [
            (distinct[h], n, distinct[t] if s > 1 else None)
            for h, n, t, s in zip(heads.tolist(), total.tolist(), tails.tolist(), size.tolist())
        ]

    def composed(self, owner: np.ndarray, maps: list) -> tuple[np.ndarray, list]:
        """One step of the scan: neighbours of one text in pairs."""
        left = np.zeros(len(owner), bool)
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        left[:-1] = (owner[1:] == owner[:-1]) & (place[:-1] % 2 == 0)
        right = np.r_[False, left[:-1]]
        pairs = [(maps[i], maps[i + 1]) for i in np.flatnonzero(left)]
        middle = [(a[2] or "") + b[0] if a[2] is not None and b[2] is not None else "" for a, b in pairs]
        counts = iter(self.words([w for w in middle if w]).tolist())
        joined = iter([join(a, b, next(counts) if w else 0) for (a, b), w in zip(pairs, middle)])
        return owner[~right], [next(joined) if left[i] else maps[i] for i in np.flatnonzero(~right)]


def join(a: tuple, b: tuple, between: int) -> tuple[str, int, str | None]:
    """The map of two chunks; ``between`` counts the word that both ends make, if both have white space."""
    if a[2] is None:
        return a[0] + b[0], b[1], b[2]
    if b[2] is None:
        return a[0], a[1], a[2] + b[0]
    return a[0], a[1] + between + b[1], b[2]


def cut(text: bytes) -> list[str]:
    """Chunks of about CHUNK_BYTES, between characters."""
    out, at = [], 0
    while at < len(text):
        to = min(len(text), at + CHUNK_BYTES)
        while to < len(text) and text[to] & 0xC0 == 0x80:
            to += 1
        out.append(text[at:to].decode())
        at = to
    return out


COUNTERS: dict[str, Counter] = {}


def token_counts(
    docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = COUNTERS.get(path) or COUNTERS.setdefault(path, Counter(path))
        for batch in batches:
            for part in slices(batch):
                n = counter.texts(part.column("text"))
                size = pc.binary_length(part.column("text")).cast(pa.int64())
                columns = [part.column("id"), size, pa.array(n), pa.array(n > limit)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens", "over_limit"])

    longs = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_tokens")]
    schema = T.StructType([rows.schema["id"], *longs, T.StructField("over_limit", T.BooleanType())])
    return mapped(rows, run, schema)


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    """All documents against a limit of 2048 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, public_tokenizers.path(VOCABULARY)).withColumnRenamed("id", "doc_id")
