import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import pytest  # noqa: E402

WORDS = "river stone lamp cloud ember quartz meadow signal harbour violin copper thistle orbit candle ledger marble".split()


@pytest.fixture
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns named like working columns."""
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, "a"), (None, "one two three four five", "en", None), (5, "x" * 300_000, "en", "b"),
        (6, " ".join(WORDS * 4000), "de", "b"), (7, "same text here " * 10, "en", "b"), (7, "same text here " * 10, "en", "b"), (8, "same text here " * 10, "en", "c"),
        (9, "naïve Ünïcode 漢字 😀 don't   stop\u0085now", "en", "c"),
    ]
    names = ["_row", "_upper", "_part", "_rank", "_from", "words", "part", "fp", "features", "offset", "rank"]
    return spark.createDataFrame([(*r, "keep", 1, 0.5, *names) for r in rows],
                                 "doc_id long, text string, lang string, source string, _block string, n_words int, score double, " + ", ".join(f"`{n}` string" for n in names))


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
