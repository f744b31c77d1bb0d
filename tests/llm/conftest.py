import pytest

from tessera.session import ship_package


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    ship_package(spark)


ODD = [(1, "Alpha beta gamma, delta.\nEpsilon zeta."), (2, None), (3, ""), (4, "Alpha beta gamma, delta.\nEpsilon zeta."),
       (4, "Alpha beta gamma, delta.\nEpsilon zeta."), (None, "  \n\n <|endoftext|> x"), (None, None), (5, "word " * 30000),
       (6, "x" * 50000), (7, "Alpha  beta gamma,\tdelta. Epsilon zeta.")]
CLASH = ("shard", "size", "n_tokens", "key", "fp", "label", "window", "row", "hash", "norm", "sha", "hub")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASH)
    return spark.createDataFrame([r + tuple("?" for _ in CLASH) for r in ODD], schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
