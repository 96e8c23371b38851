"""The byte networks' scores against a plain forward pass, a byte and a filter at a time."""

import math

import numpy as np
import pyarrow as pa
import pytest

from rootwise.llm.bytecnn import BLOCK
from rootwise.llm.language import WIDTHS, LanguageNet
from rootwise.llm.quality import QualityNet

TEXTS = [
    None, "", "a", "\x00", "a\x00b", "é" * 100, "x" * BLOCK, "xy" * (BLOCK // 2) + "z", "q" * (2 * BLOCK),
    "q" * (2 * BLOCK) + "r", " ".join(f"word{i % 37}" for i in range(130)), "日本語 " * 70, "😀" * 65,
]


def block_maxima(conv, text):
    """The largest response of every filter per block of a text; zeros stand behind its end."""
    data = (text or "").encode()
    embedding, filters = conv.embedding.tolist(), conv.filters.T.tolist()
    out = []
    for block in range(max(1, math.ceil(len(data) / BLOCK))):
        best = [-math.inf] * len(filters)
        for place in range(block * BLOCK, (block + 1) * BLOCK):
            seen = [x for k in range(conv.width) for x in embedding[data[place + k] if place + k < len(data) else 0]]
            for f, weights in enumerate(filters):
                best[f] = max(best[f], sum(w * x for w, x in zip(weights, seen, strict=True)))
        out.append(best)
    return out


def plain_quality(net, text):
    blocks = block_maxima(net.conv, text)
    pairs = list(zip(blocks, blocks[1:], strict=False)) or [(blocks[0], blocks[0])]
    chunks = [
        [max(0.0, max(x, y) + float(b)) for x, y, b in zip(one, two, net.bias, strict=True)] for one, two in pairs
    ]
    columns = list(zip(*chunks, strict=True))
    feature = [max(c) for c in columns] + [min(c) for c in columns] + [sum(c) / len(c) for c in columns]
    feature.append(min(len((text or "").encode()), 2 * BLOCK) / (2 * BLOCK))
    logit = float(net.offset[0])
    for unit in range(len(net.weight)):
        into = sum(x * float(w) for x, w in zip(feature, net.hidden[:, unit], strict=True)) + float(net.hidden_bias[unit])
        logit += max(0.0, into) * float(net.weight[unit])
    return 1 / (1 + math.exp(-logit))


def plain_language(net, text):
    size = len((text or "").encode())
    total = [0.0] * len(net.languages)
    weights = 0
    for n, best in enumerate(block_maxima(net.conv, text)):
        logits = [
            float(net.offset[language])
            + sum(max(0.0, x + float(b)) * float(w) for x, b, w in zip(best, net.bias, net.weight[:, language], strict=True))
            for language in range(len(net.languages))
        ]
        shares = [math.exp(x - max(logits)) for x in logits]
        used = max(1, min(BLOCK, size - n * BLOCK))
        weights += used
        total = [t + used * s / sum(shares) for t, s in zip(total, shares, strict=True)]
    return [t / weights for t in total]


def test_quality_scores_are_the_plain_forward_pass():
    net = QualityNet(seed=4)
    random = np.random.default_rng(1)
    net.bias[:] = random.normal(0, 0.3, len(net.bias))
    net.hidden_bias[:] = random.normal(0, 0.3, len(net.hidden_bias))
    net.weight[:] = random.normal(0, 0.5, len(net.weight))
    net.offset[:] = -0.2
    want = [plain_quality(net, text) for text in TEXTS]
    assert net.scores(pa.array(TEXTS, pa.string())) == pytest.approx(want, abs=1e-4)
    assert max(want) - min(want) > 0.01
    # a text's score does not depend on its neighbours
    assert [float(net.scores(pa.array([text], pa.string()))[0]) for text in TEXTS] == pytest.approx(want, abs=1e-4)


def test_language_probabilities_are_the_plain_forward_pass():
    net = LanguageNet(["de", "en", "fr"], seed=4)
    random = np.random.default_rng(2)
    net.bias[:] = random.normal(0, 0.3, len(WIDTHS))
    net.weight[:] = random.normal(0, 0.5, net.weight.shape)
    net.offset[:] = random.normal(0, 0.3, 3)
    most, share = net.predict(pa.array(TEXTS, pa.string()))
    for text, language, got in zip(TEXTS, most, share, strict=True):
        want = plain_language(net, text)
        assert got == pytest.approx(max(want), abs=1e-4)
        assert want[language] == pytest.approx(max(want), abs=1e-4)
    assert len(set(most.tolist())) > 1
