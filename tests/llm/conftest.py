import pytest

LONG = " ".join(f"long{i % 9000}" for i in range(20_000))
ODD = [
    (None, None, None), (1, "", "a"), (1, " \n\t", None), (2, "one", "a"), (2, "one", "a"), (3, "Two words", "b"),
    (4, "mail a.b@c.d.e or +1 (555) 123-4567, ip 1.2.3.4, 256.1.1.1, card 4111 1111 1111 1111.", "b"),
    (5, "<|endoftext|> it's IT'S \u0130stanbul \u03a3\u03b1\u03c2 e\u0301 \u00a0x  ", "c"), (6, LONG, "c"), (7, LONG + " end", "c"),
    (8, "x" * 60_000, "c"), (9, "same line of words here\n" * 30, "d"), (None, "one", None),
]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """Nulls, empty and blank texts, repeated rows and ids, long texts, and a column named like an output."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    rows = [(*r, 7, "clash") for r in ODD]
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens int, component_id string").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(odd, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    odd.limit(0).write.parquet(path)
    return odd.sparkSession.read.parquet(path)


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


def ordered(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(params=["odd", "none", "documents"])
def docs(request):
    return request.getfixturevalue(request.param)
