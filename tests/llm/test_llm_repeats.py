import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import byte_repeats, repeats, word_repeats


def spans(flags):
    return sum(1 for a, b in zip([0, *flags], flags) if b and not a)


def without_bytes(rows, window):
    """(id, bytes, removed, spans, kept) of every row, by comparing all strings."""
    texts = [(r["text"] or "").encode() for r in rows]
    seen = {}
    for t in texts:
        for i in range(len(t) - window + 1):
            seen[t[i : i + window]] = seen.get(t[i : i + window], 0) + 1
    out = []
    for r, t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((r["doc_id"], len(t), sum(gone), spans(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def without_words(rows, window):
    """(id, words, removed, kept) of every row; rows equal in id and text count as one."""
    order = {(r["doc_id"], r["text"]): r["key"] for r in rows}
    ranked = sorted(order, key=lambda k: (k[0] is not None, k[0] or 0, order[k]))
    seen, result = set(), {}
    for name in ranked:
        words = (name[1] or "").encode().split()
        gone = [0] * len(words)
        for i in range(len(words) - window + 1):
            if tuple(words[i : i + window]) in seen:
                gone[i : i + window] = [1] * window
            seen.add(tuple(words[i : i + window]))
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        result[name] = (name[0], len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return sorted((result[r["doc_id"], r["text"]] for r in rows), key=str)


def keyed(docs):
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")).collect()


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def bytes_got(df):
    return plain(df.select("id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)))


def words_got(df):
    return plain(df.select("id", "n_words", "n_removed", F.sha2("kept", 256)))


@pytest.fixture(params=["phrases", "windows"])
def crowds(request, monkeypatch):
    """Triggers kept together, or cut into single windows from the third phrase on."""
    if request.param == "windows":
        monkeypatch.setattr(repeats, "CROWDED", 2)


def test_byte_query(spark, folder, documents, crowds):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = plain(byte_repeats.op4_suffix_array_dedup(spark, folder).select(*columns))
    assert found == without_bytes(documents.collect(), 200)


def test_word_query(spark, folder, documents, crowds):
    found = plain(word_repeats.op9_substring_dedup(spark, folder).select("doc_id", "n_words", "n_removed", "kept_sha256"))
    assert found == without_words(keyed(documents), 20)


@pytest.mark.parametrize("window", [7, 30])
def test_bytes_of_odd_rows(odd_docs, window, crowds):
    docs = odd_docs.filter("doc_id is null or doc_id not in (12, 13)")
    assert bytes_got(byte_repeats.without_repeats(docs, window)) == without_bytes(docs.collect(), window)


@pytest.mark.parametrize("window", [2, 6])
def test_words_of_odd_rows(odd_docs, window, crowds):
    assert words_got(word_repeats.without_repeats(odd_docs, window)) == without_words(keyed(odd_docs), window)


def test_long_texts_in_small_pieces(odd_docs, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 1000)
    docs = odd_docs.filter("doc_id in (11, 12, 13, 0)")
    assert bytes_got(byte_repeats.without_repeats(docs, 40)) == without_bytes(docs.collect(), 40)


def test_no_rows(no_docs):
    assert byte_repeats.without_repeats(no_docs).count() == 0
    assert word_repeats.without_repeats(no_docs).count() == 0


def test_fm_index_finds_what_is_there():
    import numpy as np

    draw = np.random.default_rng(3)
    phrases = [draw.integers(1, 5, n) for n in (9, 4, 12, 30, 1)]
    text = np.concatenate([np.r_[p, 0] for p in phrases])
    ends = np.flatnonzero(text == 0)
    index = word_repeats.FMIndex(text, ends, 5)
    for pattern in ([1], [2, 3], [4, 4, 1], phrases[1].tolist(), [1, 2, 1, 2, 1]):
        low, high = np.zeros(1, np.int64), np.full(1, len(text))
        for symbol in reversed(pattern):
            low, high = index.extend(np.array([symbol]), low, high)
        places = {i for i in range(len(text)) if text[i : i + len(pattern)].tolist() == pattern}
        assert set(index.order[low[0] : high[0]].tolist()) == places


def test_suffix_ranks():
    import numpy as np

    data = np.frombuffer(b"abracadabra abracadabra", np.uint8)
    for depth in (1, 3, 7, 12):
        ranks = byte_repeats.suffix_ranks(data, depth)
        heads = [bytes(data[i : i + depth]) for i in range(len(data))]
        for i, a in enumerate(heads):
            for j, b in enumerate(heads):
                assert (ranks[i] == ranks[j]) == (a == b) and (ranks[i] < ranks[j]) == (a < b)
