"""The license index against a plain reading of every template at every place."""

import math

from rootwise.llm.licenses import BASE, ENOUGH, RARE, SENTENCES, license_index, license_scan, templates

from tests.llm import brute

TEXTS = [(label, text.split(), phrase.split(), False) for label, text, phrase in SENTENCES]
TEXTS += [(label, phrase.split(), phrase.split(), True) for phrase, label in BASE.items()]


def by_hand(all_words):
    """Labels and score per list of words."""
    n = len(all_words)
    idf = {
        word: math.log((1 + n) / (1 + sum(word in own for own in all_words))) + 1
        for _, text, _, _ in TEXTS
        for word in text
    }
    for own in all_words:
        labels, score = set(), 0.0
        for label, text, phrase, base in TEXTS:
            at = next(i for i in range(len(text)) if text[i : i + len(phrase)] == phrase)
            for place in range(len(own)):
                if own[place : place + len(phrase)] != phrase or place < at:
                    continue
                there = own[place - at :]
                share = sum(idf[w] for w, x in zip(text, there) if w == x) / sum(map(idf.get, text))
                if base or share >= ENOUGH:
                    labels.add(label)
                    score = max(score, min(1.0, share))
        yield ",".join(sorted(labels)), round(score, 6)


def test_every_template_is_found_whole_damaged_and_cut(spark):
    texts = ["", "license mit mit license", "by cc by cc by nc", "cc by " * 200, "general gnu license public"]
    for _, text, phrase, _ in TEXTS:
        full, key = " ".join(text), " ".join(phrase)
        texts += [full, full.upper(), f"intro {full} outro {full}", key, full.replace(key, "x " + key)]
        texts.append(" ".join("x" if i % 4 == 0 and w not in phrase else w for i, w in enumerate(text)))
        texts.append(" ".join("x" if i % 2 == 0 and w not in phrase else w for i, w in enumerate(text)))
        texts.append(" ".join(text[: text.index(phrase[-1]) + 1]))
        texts.append(" ".join(reversed(text)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan(docs).collect()}
    want = list(by_hand([brute.words(text) for text in texts]))
    assert [got[i] for i in range(len(texts))] == want


def test_the_index_holds_the_rarest_mandatory_words(spark):
    known = templates()
    rarity = {word: float(len(word)) for t in known for word in t.words}
    index = license_index(known, rarity)
    row = spark.range(1).select(index.postings.alias("postings"), index.rarest.alias("rarest")).first()
    for number, template in enumerate(known):
        key = [template.words[k] for k in template.key]
        rarest = sorted(key, key=lambda w: -rarity[w])[:RARE]
        assert sum(map(len, row["rarest"][number])) == sum(map(len, set(rarest)))
        mine = [(w, p) for w, found in row["postings"].items() for p in found if p["template"] == number]
        assert sorted(p["rank"] for _, p in mine) == list(range(RARE))
        assert all(template.words[p["position"]] == w and p["position"] in template.key for w, p in mine)
