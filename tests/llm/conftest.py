import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from conftest_llm import VOCABULARY, prose  # noqa: E402

from tidegrid.session import configure  # noqa: E402

CLASHING = ["row", "f", "g", "n", "sig", "part", "size", "target", "shard", "quota", "h", "spans", "places", "starts", "label", "root", "vector", "turns", "words"]


@pytest.fixture
def corpus(spark):
    """Make documents from (doc_id, text, lang, source) rows, with columns named like the operators' own."""
    configure(spark)

    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        if extra:
            for c in CLASHING:
                df = df.selectExpr("*", f"'clash' AS {c}")
        return df

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and very long texts, near and exact copies, repeated rows and ids."""
    rng = random.Random(5)
    base = [prose(rng, n) for n in (3, 9, 30, 80, 200, 400)]
    rows = [(i, t, "en", "a") for i, t in enumerate(base)]
    for i in range(30):
        words = base[rng.randrange(2, 6)].split(" ")
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        rows.append((10 + i, " ".join(words), "fr", rng.choice(["a", "b", None, "é"])))
    rows += [(50, base[4], "en", "a"), (51, base[4], None, "b"), (52, base[3] + " " + base[5], "de", "b"), (53, prose(rng, 60_000), "en", "a")]
    rows += [(60, None, "en", None), (61, "", None, "a"), (62, " \n\t ", "en", "b"), (63, "word", "en", "a"), (64, "word", "en", "a"), (65, "12 ,.", "en", "a")]
    rows += [(70, base[2], "en", "a")] * 3 + [(71, base[3], "en", "a"), (71, base[5], "en", "b"), (None, base[5], "en", "a"), (None, None, None, None)]
    return rows
