from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from texts import CLASHING, prose  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns.

    The extra columns have the names that the operators use for their own.
    """
    rng = random.Random(5)
    long = prose(rng, 30_000) + "\n" + prose(rng, 10)
    rows = [
        (1, "One two three four five.\nOne two three four five.", "a", 7),
        (1, "One two three four five.\nOne two three four five.", "a", 7),
        (1, "Another text of the same id.", "b", 7),
        (2, None, "a", None), (3, "", None, 1), (4, " \t\n\x0b\x0c\r ", "b", 1),
        (None, "A text without id.", None, 1), (None, "a TEXT without id.", "b", 1), (None, None, None, None),
        (5, "ÄÖ é ́ İ K \x00 \x1c\x85  ​ 日本 end", "c", 1),
        (6, long, "c", 1), (7, long.upper(), "c", 1), (8, "<|endoftext|> 's \U0001f600 x\r\ny", "c", 1),
    ]
    columns = "doc_id bigint, text string, source string, kept int"
    return spark.createDataFrame(rows, columns).selectExpr(
        "*", *[f"CAST(concat('own ', kept, ' {c}') AS STRING) AS {c}" for c in CLASHING]
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("doc_id = 99").coalesce(1)
