import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_counts, token_store

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "",
    " ",
    "  ",
    "a  b",
    " a",
    "a ",
    "a \n b",
    "don't  stop 'LL''re 's's",
    "<|endoftext|> hi<|endoftext|>x <|startoftext|>",
    "a　b c",
    "tab\t x",
    "１2 3½ ² 12,345.67",
    "Ünïcödé ẞ ΣΑΣ Σ İstanbul ﬁ",
    "日本語 テキスト 🙂🙂 hi🙂",
    "é x́",
    "a\x1cb \x1f a\x85 b a\x0b b",
    "​ q",
    "x" * 3000 + " y",
    "end\n",
]


def rows(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize(("n", "most"), [(1, 18), (2, 18), (5, 18), (300, 18), (300, 9), (20_000, 18)])
def test_code(n, most):
    draw = random.Random(n)
    counts = {3 * i: int(draw.paretovariate(0.6)) for i in range(n)}
    lengths = token_store.code_lengths(counts, most)
    assert max(lengths.values()) <= most and sum(2.0**-x for x in lengths.values()) <= 1 + 1e-9
    ids = np.array(draw.choices(list(counts), weights=counts.values(), k=5000), np.uint32)
    code = token_store.Code(lengths)
    bits, offsets = code.write(ids)
    assert (code.read(bits, offsets, len(ids)) == ids).all()


def test_code_without_limit_is_optimal():
    import heapq

    draw = random.Random(5)
    counts = {i: draw.randrange(1, 1000) for i in range(200)}
    heap, cost = sorted(counts.values()), 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    lengths = token_store.code_lengths(counts, 18)
    assert sum(counts[i] * lengths[i] for i in counts) == cost


def test_too_many_ids_for_the_limit():
    with pytest.raises(ValueError):
        token_store.code_lengths(dict.fromkeys(range(5), 1), 2)


def test_pieces_encode_as_whole_texts():
    library, encoder = Tokenizer.from_file(BYTE_BPE), token_store.Encoder(BYTE_BPE)
    stops = [".", ". first. second, third", ",", ", and. so, on.,", "word.", "... more... words,,"]
    for texts in (stops, ODD, ["new words here. and, there.", *stops], ODD[::-1], stops[::-1]):
        ids, counts = encoder.encode(pa.array(texts))
        for text, one in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
            assert one.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_token_files(spark, folder, documents):
    library = Tokenizer.from_file(BYTE_BPE)
    found, start = rows(token_store.op5_token_id_output(spark, folder)), 0
    for r in sorted(documents.collect(), key=lambda r: r["doc_id"]):
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        assert found[r["doc_id"]] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files_of_odd_rows(spark, odd_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_TOKENS", 500)
    token_store.write_tokens(odd_docs, str(tmp_path / "t"), BYTE_BPE)
    found = token_store.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    library = Tokenizer.from_file(BYTE_BPE)
    want = sorted(
        (r["doc_id"] is not None, r["doc_id"] or 0, [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0])
        for r in odd_docs.collect()
    )
    got = [(r["id"] is not None, r["id"] or 0, np.frombuffer(r["tokens"], "<u4").tolist()) for r in found]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert sorted(got) == want
    sizes = [r["n_tokens"] for r in found]
    assert [r["start"] for r in found] == [sum(sizes[:i]) for i in range(len(sizes))]


def test_token_files_without_rows(spark, no_docs, tmp_path):
    token_store.write_tokens(no_docs, str(tmp_path / "t"), BYTE_BPE)
    assert token_store.read_tokens(spark, str(tmp_path / "t")).count() == 0


@pytest.mark.parametrize("chunk", [7, 1 << 16])
def test_counts_as_the_library(monkeypatch, chunk):
    monkeypatch.setattr(token_counts, "CHUNK_BYTES", chunk)
    library, counter = Tokenizer.from_file(WORD_BPE), token_counts.Counter(WORD_BPE)
    texts = [*ODD, "The quick brown föx jumps überall " * 9 + "x" * 100 + " end" + "  " * 30, "", "a b"]
    if chunk == 7:  # a special string counts wherever it is cut
        texts.append("ab<|endoftext|>cd <|endoftext|>")
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter.texts(pa.array(texts)).tolist() == want


def test_transducer_starts_over_when_full(monkeypatch, documents):
    library, counter = Tokenizer.from_file(WORD_BPE), token_counts.Counter(WORD_BPE)
    monkeypatch.setattr(token_counts, "MOST_STATES", 500)
    monkeypatch.setattr(token_counts, "CACHED_WORDS", 100)
    for r in documents.limit(20).collect():
        assert counter.texts(pa.array([r["text"]]))[0] == len(library.encode(r["text"], add_special_tokens=False).ids)


def test_token_counts_query(spark, folder, documents):
    library = Tokenizer.from_file(WORD_BPE)
    found = rows(token_counts.op6_token_counts(spark, folder).select("doc_id", "n_bytes", "n_tokens", "over_limit"))
    for r in documents.collect():
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        assert found[r["doc_id"]] == (len((r["text"] or "").encode()), n, n > 2048)


def test_token_counts_of_odd_rows(odd_docs, no_docs):
    library = Tokenizer.from_file(WORD_BPE)
    found = sorted(map(tuple, token_counts.token_counts(odd_docs, WORD_BPE).select("id", "n_tokens").collect()), key=str)
    want = [(r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd_docs.collect()]
    assert found == sorted(want, key=str)
    assert token_counts.token_counts(no_docs, WORD_BPE).count() == 0


def test_very_many_empty_texts(spark, tmp_path):
    """A block of one id a document is written in time that grows with their number alone."""
    docs = spark.range(300_000).selectExpr("id as doc_id", "if(id % 2 = 0, '', null) as text")
    token_store.write_tokens(docs, str(tmp_path / "files"), BYTE_BPE)
    found = token_store.read_tokens(spark, str(tmp_path / "files"))
    assert found.count() == 300_000
    assert found.filter("n_tokens <> 1 or start <> id").count() == 0


def test_words_at_line_ends_and_before_marks_are_encoded_once():
    library, encoder = Tokenizer.from_file(BYTE_BPE), token_store.Encoder(BYTE_BPE)
    words = ["alpha", "Beta", "gamma", "délta"]
    texts = [f"so {a}\n{b} {a}{m} {b}{m}\n{a}" for a in words for b in words for m in ("", "$$$", "!?", ".,#")]
    encoder.encode(pa.array(texts))
    assert len(encoder.number) <= 1 + 3 * len(words) + 3  # with a space, with a line end, and the marks
    texts += ["a\n", "\na", "a\n\nb.\n c", "a\r\nb", "a<|endoftext|>#\n<|endoftext|>", "x|> y#>\nz", "日#\nb", " \nb"]
    ids, counts = encoder.encode(pa.array(texts))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for each in want for i in each] and counts.tolist() == list(map(len, want))


def test_a_full_cache_keeps_the_pieces_that_came_again(monkeypatch):
    monkeypatch.setattr(token_store, "CACHED_PIECES", 45)
    library, encoder = Tokenizer.from_file(BYTE_BPE), token_store.Encoder(BYTE_BPE)
    asked, encode = [], encoder.library
    monkeypatch.setattr(encoder, "library", lambda joined, alone: asked.extend([*joined, *alone]) or encode(joined, alone))
    for turn in range(6):
        texts = [f"the common words and {turn}x{i} more, {i}\nthe end" for i in range(12)] + ["", "the end"] * (turn % 2)
        ids, counts = encoder.encode(pa.array(texts))
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert ids.tolist() == [i for each in want for i in each] and counts.tolist() == list(map(len, want))
    assert asked.count(" common") == 1 and len(encoder.number) < 70
    encoder.again = encoder.again[:0]
    encoder.forget_rare()
    assert encoder.number == {} and len(encoder.encode(pa.array(["a b", ""]))[0]) == 2
