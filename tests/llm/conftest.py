import random

import pytest
from pyspark.sql import types as T

#: Extra columns under names that the operators use themselves.
CLASHING = ["row", "block", "bucket", "kept", "ids", "score", "shard", "slot", "n_words", "token", "component_id", "accepted", "_block"]


def prose(rng, n, words=60):
    return " ".join(rng.choice(["ab", "Cd", "efg", "hé", "ij."]) + str(rng.randrange(words)) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty, blank and very long texts, copies, near copies, repeated rows and shared ids."""
    rng = random.Random(11)
    base = [prose(rng, 60) for _ in range(6)]
    near = base[0].split()
    near[30] = "changed"
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20, base[0]), (21, base[1]), (22, " ".join(near)), (23, base[2] + " tail " + base[3]), (24, prose(rng, 3))]
    rows += [(25, None), (26, ""), (27, " \t\n "), (28, "word"), (29, "be " * 400), (30, prose(rng, 30000, 10**6))]
    rows += [(31, "x" * 700), (32, base[4][:150] + "\n" + base[5][-150:]), (33, "中文" * 90), (33, base[0][:80])]
    rows += [(34, "same row " + base[5])] * 3 + [(None, base[1]), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *[T.StructField(c, T.StringType()) for c in CLASHING]])
    return spark.createDataFrame([(*row, *["x"] * len(CLASHING)) for row in edge_rows], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.filter("doc_id < -1")
