import os

import pytest

pytest.importorskip("fleetdw.llm")
os.environ.setdefault("OMP_NUM_THREADS", "1")

#: Texts that every operator must get through.
ODD_TEXTS = [None, "", " \n\t ", "a", "word " * 3000, "x" * 30000, "é中😀 ñ", "same", "same"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing extra columns."""
    rows = [(i, t, "en", f"s{i % 2}", 7, "clash") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", None, None, None, None), (3, "a", "en", "s1", 7, "clash"), (3, "a", "en", "s1", 7, "clash"),
             (4, "another text with the same id", "en", None, 7, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score long, start string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
