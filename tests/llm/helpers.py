"""Fixtures shared by the corpus operators' tests."""

from pyspark.sql import functions as F

LOREM = ("the quick brown fox jumps over the lazy dog while seven wizards quietly mix a jug of bright blue paint near "
         "the old stone bridge and nobody asks them why").split()
LONG = " ".join(LOREM[(i * i + i // 7) % len(LOREM)] + str(i % 977) for i in range(30000))
#: Nulls, empty and blank texts, repeated rows and ids, near copies, short and very long texts.
DOCS = [
    (1, " ".join(LOREM)), (2, " ".join(LOREM)), (3, " ".join(LOREM[:-1]) + " not"), (4, "Only four words here"),
    (5, None), (6, ""), (7, " \n\t "), (8, "only FOUR words here"), (9, "x"), (10, "x"), (10, "x"), (11, LONG),
    (12, LONG + " tail"), (13, "head " + LONG), (14, "Ünïcode wörds 中文 mixed in a text of some more words than a dozen so it has windows"),
    (14, "another text under the id fourteen"), (None, "a text without an id"), (None, " ".join(LOREM)), (15, "w" * 1_200_000 + " end"),
    (16, " ".join(LOREM * 3)), (17, "a b c d e"), (18, "a b c d e"), (19, "A B C D E F"),
]


def docs_of(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("id", "rid", "chunk", "kept", "digest", "n", "block", "score", "token", "at", "name"):
        df = df.withColumn(name, F.lit(name))
    return df.withColumn("lang", F.lit(None).cast("string"))


def edge_docs(spark):
    return docs_of(spark, DOCS).repartition(3)


def empty_docs(spark):
    return docs_of(spark, [])


def by_id(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))


def vectors_of(spark, rows, kind="float"):
    """Vectors with columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    for name in ("id", "vec", "print", "asks", "block", "key", "cluster", "distance", "sketch", "n", "radius", "copies"):
        df = df.withColumn(name, F.lit(name))
    return df.withColumn("label", F.lit(None).cast("int"))
