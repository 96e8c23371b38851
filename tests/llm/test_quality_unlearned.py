"""Quality scores where no label can be learned from."""

import pytest

from rootwise.llm.quality import of_quality, quality_scores
from tests.llm.test_operators import pairs, same


@pytest.mark.parametrize("rows", [[], [(1, None), (2, 7), (99, 1), (None, 1)]])
def test_every_score_is_a_half(spark, odd_docs, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    assert {(r["score"], r["predicted"]) for r in quality_scores(odd_docs, labels).collect()} == {(0.5, 1)}
    same(pairs(of_quality(odd_docs, labels)), pairs(odd_docs))
