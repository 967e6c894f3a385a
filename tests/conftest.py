import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from termdex.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

# Hand corpus of FIXTURES.md section 3.
HAND_CORPUS = {
    "a.txt": "Cloud cloud, computing!\nIt's CLOUD-based.\n",
    "b.txt": "computing on a cloud",
    "c.txt": "..., !!!\n\n",
    "d.txt": "Città 2025 x_y",
}

HAND_INDEX_TAB = [
    "2025\td.txt:1",
    "a\tb.txt:1",
    "based\ta.txt:1",
    "citt\td.txt:1",
    "cloud\ta.txt:3\tb.txt:1",
    "computing\ta.txt:1\tb.txt:1",
    "it\ta.txt:1",
    "on\tb.txt:1",
    "s\ta.txt:1",
    "x\td.txt:1",
    "y\td.txt:1",
]


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def corpus_dir(tmp_path):
    d = tmp_path / "corpus"
    d.mkdir()
    for name, text in HAND_CORPUS.items():
        (d / name).write_text(text, encoding="utf-8")
    return str(d)


@pytest.fixture()
def hand_docs(spark):
    return spark.createDataFrame(sorted(HAND_CORPUS.items()), "doc string, text string")
