"""Tables with everything that may go wrong in them."""

import random

import pytest

WORDS = "the of and wind over hill river stone light dark seven eight north south Ünder öl niño".split()
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_key long, _row string, fp string, shard string, n_tokens double, _epoch int"
)


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(50)) for _ in range(n))


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), 1, "r", "f", "s", 0.5, 3)


@pytest.fixture(scope="session")
def odd_rows():
    same = prose(1, 120)
    near = same.split()
    near[60] = "changed"
    return [
        row(0, same),
        row(1, same, source="b"),
        row(2, " ".join(near)),
        row(3, None),
        row(4, ""),
        row(5, " \t\n\x0b "),
        row(6, "word"),
        row(7, "Two\nwords"),
        row(8, same, None, None),
        row(9, prose(2, 300), "xx", None),
        row(9, prose(2, 300), "xx", None),
        row(9, prose(3, 40)),
        row(None, prose(4, 60), "de"),
        row(None, prose(4, 60), "de"),
        row(None, None, None, None),
        row(10, "be " * 400),
        row(11, prose(5, 80) + "\n" + same + "\n" + prose(6, 80)),
        row(12, prose(7, 60_000), "fr", "long"),
        row(13, "x" * 100_000, "fr", "long"),
        row(14, "|#* ab　c   d\x1fe 'tis don't  <|endoftext|> 12,5", "es", ""),
        row(15, prose(8, 90), "en", "b"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(odd_rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
