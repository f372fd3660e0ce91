import random

import pytest
from pyspark.sql import types as T

CLASHING = ["digest", "kept", "sequence_id", "offset", "node", "blob", "spans", "key", "part", "row", "rule", "component_id",
            "__digest", "__own", "__blob", "__spans", "__id", "__kept", "own_blob", "gaps", "stop", "gone_id", "Gone_SHA"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASHING])


def prose(rng, n):
    parts = ["ka", "lo", "mi", "ré", "shu", "ton", "ver", "zäu", "pre"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def texts():
    """(doc_id, text): nulls, empties, odd signs, copies, near copies, repeated rows and a very long text."""
    rng = random.Random(11)
    base = [prose(rng, rng.randint(5, 160)) for _ in range(24)]
    rows = [(10 + i, t) for i, t in enumerate(base)]
    rows += [(100, None), (101, ""), (102, "   "), (103, "one"), (104, "two words"), (105, None), (106, "")]
    rows += [(110, base[0]), (111, base[0].replace(" ", " \t\n ")), (3, base[1]), (112, base[1].upper()), (None, base[2]),
             (None, None), (113, "a\n\na\n b \nb"), (114, "漢字かな 👍🏽 ſecret   x \x1c y \x00 ՘ \U0001fae9"),
             (115, "<|endoftext|> <s> </s> <unk> ▁▁ <|endoftext|>"), (116, "'ll 'LL don't    tabs\t\t\tend   "),
             (117, "the the the the the the the " * 9)]
    rows += [(120, base[5]), (120, base[5]), (120, base[5])]
    long = prose(rng, 30_000)
    rows += [(130, long), (131, long + " tail"), (132, "x" * 3000), (133, " " * 700 + "y" * 700)]
    for k in range(12):
        words = prose(rng, 120).split() if k == 0 else words  # noqa: F821
        near = list(words)
        for _ in range(k // 2):
            near[rng.randrange(len(near))] = f"new{k}"
        rows.append((200 - k, " ".join(near)))
    key = "0123456789abcdef" * 3
    rows += [(300, f"password = 'hunter2hunter2' and token:short, AKIAABCDEFGHIJKL {key}"),
             (301, f'API_KEY="{key}" ApiKey: abcd1234é secret=token=abcdefghij AKIA123'),
             (302, f"ééé PASSWD={key}{key} tail {key[:31]} {key[:32]}"), (303, f"password = 'hunter2hunter2' and token:short, AKIAABCDEFGHIJKL {key}")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return texts()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *["x"] * len(CLASHING)) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    """Labels of the odd documents: short and repetitive ones are bad."""
    data = [(i, int(t is not None and len(set(t.split())) > 20), 0) for i, t in texts() if i is not None]
    return spark.createDataFrame(data + [(None, 1, 0), (10, None, None)], "doc_id long, quality int, toxic int")
