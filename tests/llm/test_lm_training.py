"""What the language model learns from."""

import numpy as np
import pytest

from rootwise.llm import gru, lm_scoring
from rootwise.scratch import Scratch


class Watched(Scratch):
    """Adds up the tokens that the one copy left at the end of each round has seen."""

    tokens = 0

    def write(self, df, *further, **counts):
        table = super().write(df, *further, **counts)
        if "seen" in df.columns and table.rows == 1:
            self.tokens += table.df.collect()[0]["seen"]
        return table


def test_the_model_learns_from_every_training_document(spark):
    docs = [(i, f"text {i % 7} of number {i} and {i % 13} more") for i in range(5000)]
    training = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    scratch = Watched(spark, "lm-test")
    vocabulary, _ = lm_scoring.count_words(scratch, training)
    lm_scoring.train_model(scratch, training, vocabulary)
    assert scratch.tokens == vocabulary.tokens == 5000 * 9


def plain_score(model, text):
    """A text's log probability, a word at a time, from the definition of the cell and the softmax."""

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    n, h, before, total = model.hidden, np.zeros(model.hidden), 0, 0.0
    for word in text:
        x = model.embed[before].astype(float) @ model.inner + model.gate
        u = h @ model.state
        z, r = sigmoid(x[:n] + u[:n]), sigmoid(x[n : 2 * n] + u[n : 2 * n])
        h = (1 - z) * np.tanh(x[2 * n :] + r * u[2 * n :]) + z * h
        kinds = h @ model.to_class + model.class_bias
        own = model.of_class[word]
        total += kinds[own] - np.log(sum(np.exp(kinds)))
        if own < model.classes - 1:
            words = {w: h @ model.to_word[w] + model.word_bias[w] for w in range(len(model.place) - 1) if model.of_class[w] == own}
            total += words[word] - np.log(sum(np.exp(list(words.values()))))
        before = word
    return total


@pytest.mark.parametrize("sizes", [[1], [3, 90, 1, 40, 33, 7], [200, 1, 1, 1]])
def test_scores_against_the_definition(sizes):
    random = np.random.default_rng(3)
    model = gru.Gru(random.integers(1, 50, 31).astype(float), hidden=5, embed=4, classes=4)
    for name in gru.NAMES:
        setattr(model, name, random.normal(0, 0.7, getattr(model, name).shape).astype(np.float32))
    texts = [np.append(random.integers(1, 31, n - 1), 0) for n in sizes]
    got = model.score(texts)
    assert np.allclose(got, [plain_score(model, text) for text in texts], rtol=1e-4, atol=1e-3)


def test_slopes_against_differences():
    """What a window's training takes off the parameters is the slope of its mean loss."""
    random = np.random.default_rng(4)
    model = gru.Gru(np.ones(9), hidden=4, embed=3, classes=3)
    for name in gru.NAMES:
        setattr(model, name, random.normal(0, 0.5, getattr(model, name).shape))
    text = np.array([3, 1, 7, 2, 0, 8, 1, 0, 5, 5, 0])
    slopes = {}
    model._adam = lambda slope, rate: slopes.update(slope)
    model.train([text], 0.1, lanes=1)

    def loss():
        return -model.score([text[:5]])[0] - model.score([text[5:8]])[0] - model.score([text[8:]])[0]

    for name in gru.NAMES:
        values = getattr(model, name)
        for at in [tuple(random.integers(0, size) for size in values.shape) for _ in range(6)]:
            held = values[at]
            values[at] = held + 1e-3
            up = loss()
            values[at] = held - 1e-3
            down = loss()
            values[at] = held
            assert abs((up - down) / 2e-3 / len(text) - slopes[name][at]) < 2e-4, name


def test_nothing_to_learn_from():
    model = gru.Gru(np.ones(5))
    assert model.train([], 0.1) == 0
    assert list(model.score([])) == []
