"""What a window of learning costs, and the words and results that its shortcuts give."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from rootwise.llm import gru, lm_scoring
from tests.llm.test_lm_training import plain_score


def test_windows_share_their_arrays():
    random = np.random.default_rng(5)
    model = gru.Gru(np.ones(300))
    texts = [np.append(random.integers(1, 300, 64 * 32 * 10 - 1), 0)]  # whole windows
    model.train(texts, 0.01)
    tracemalloc.start()
    model.train(texts, 0.01)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3_000_000


@pytest.mark.parametrize("scale", [0.5, 40])
def test_classes_computed_together_and_large_results(scale):
    """Slopes of words' rows against differences; with large weights exponentials would overflow."""
    random = np.random.default_rng(6)
    model = gru.Gru(random.integers(1, 9, 41).astype(float), hidden=4, embed=3, classes=6)
    assert max(map(len, model.groups)) > 1
    for name in gru.NAMES:
        size = scale if "_" in name else 0.5
        setattr(model, name, random.normal(0, size, getattr(model, name).shape).astype(np.float32))
    text = np.append(random.integers(1, 41, 60), 0)
    assert np.allclose(model.score([text])[0], plain_score(model, text), rtol=1e-4, atol=1e-3)
    slopes = {}
    model._adam = lambda slope, rate: slopes.update(slope)
    model.train([text], 0.1, lanes=1)
    assert all(np.isfinite(slope).all() for slope in slopes.values())
    kept = model.word_bias.astype(float)
    for word in range(0, 40, 5):
        ends = []
        for step in (1e-3, -1e-3):
            model.word_bias = kept.copy()
            model.word_bias[word] += step
            # the first window is one the slopes are of, as the state goes on
            ends.append(-plain_score(model, text[: gru.WINDOW]))
        model.word_bias = kept.copy()
        first = {}
        model._adam = lambda slope, rate, first=first: first.update(slope)
        model.train([text[: gru.WINDOW]], 0.1, lanes=1)
        assert abs((ends[0] - ends[1]) / 2e-3 / gru.WINDOW - first["word_bias"][word]) < 2e-3


@pytest.mark.parametrize("slice_size", [1, 7, 40, 4 << 20])
def test_words_of_texts(monkeypatch, slice_size):
    monkeypatch.setattr(lm_scoring, "SLICE", slice_size)
    texts = [None, "", " \t\n", "A b", "  É\x0bÀB\x0cc\x1cd\x85e f  ", "x\x00y Z", "word " * 30, "\r"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    got, start = [], 0
    for group in lm_scoring._groups(batch, 0):
        own = [[] for _ in range(len(group))]
        for owner, words in lm_scoring._words(group.column(0)):
            for place, word in zip(owner.tolist(), words.to_pylist(), strict=True):
                own[place].append(word.encode())
        got += own
        start += len(group)
    assert start == len(texts)
    assert got == [(text or "").encode().lower().split() for text in texts]
