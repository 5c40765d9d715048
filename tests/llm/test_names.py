"""Operators that return whole rows leave columns of any name as they were."""

import pytest

from plumbline.llm.exact_dedup import exact_dedup
from plumbline.llm.ngram_join import drop_near_copies

NAMES = ["__row", "__id", "__chars", "__sha", "__hash", "__key", "__stays", "__maybe", "__whole", "__best", "__word", "n", "class"]
TEXT = "one two three four five six seven eight nine ten"


@pytest.mark.parametrize("operator", [exact_dedup, drop_near_copies])
def test_clashing_columns_keep_their_values(spark, operator):
    texts = [(1, TEXT), (2, TEXT), (3, "alone in the world"), (None, TEXT), (4, None), (5, ""), (1, TEXT)]
    rows = [(i, t, *[f"{c}-{at}" for c in NAMES]) for at, (i, t) in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in NAMES))
    kept = [tuple(r) for r in operator(table).collect()]
    assert operator(table).columns == table.columns
    assert kept and set(kept) <= set(rows)
    assert sum(r[1] == TEXT for r in kept) == 1 and sum(r[0] == 3 for r in kept) == 1
