"""Every corpus operator on odd rows and empty tables, against plain Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rootwise.llm.decontaminate import benchmark_hits, contamination, decontaminated, longest_matches
from rootwise.llm.exact_dedup import build_filter, deduplicated, exact_groups, in_filter
from rootwise.llm.jaccard_join import near_deduplicated, near_groups
from rootwise.llm.language import languages
from rootwise.llm.licenses import BASE, license_scan
from rootwise.llm.lm_scoring import lm_scores
from rootwise.llm.packing import Encoder, packed, public_vocabulary
from rootwise.llm.quality import of_quality, quality_scores
from rootwise.llm.sharding import balanced_shards
from tests.llm import brute


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


# -- decontamination -------------------------------------------------------------------


@pytest.mark.parametrize("block_bytes", [1 << 24, 100])
def test_contamination(odd_docs, small_benchmark, block_bytes):
    items = [tuple(r) for r in small_benchmark.collect()]
    got = contamination(odd_docs, small_benchmark, block_bytes=block_bytes).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )
    same(map(tuple, got.collect()), [(i, *brute.contamination(t, items)) for i, t in pairs(odd_docs)])


def test_decontaminated_keeps_rows_and_columns(odd_docs, small_benchmark):
    items = [tuple(r) for r in small_benchmark.collect()]
    kept = decontaminated(odd_docs, small_benchmark)
    assert kept.columns == odd_docs.columns
    same(pairs(kept), [(i, t) for i, t in pairs(odd_docs) if not brute.contamination(t, items)[-1]])


def test_contamination_of_nothing(odd_docs, small_benchmark):
    assert contamination(odd_docs.limit(0), small_benchmark).count() == 0
    assert contamination(odd_docs, small_benchmark.limit(0)).where("n_hit > 0 or contaminated").count() == 0


def test_longest_matches(spark, odd_docs, small_benchmark):
    got = longest_matches(odd_docs, small_benchmark).where("item_id = '1'").collect()
    assert {(r["doc_id"], r["doc_word"], r["item_word"], r["n_words"]) for r in got} == {(9, 1, 0, 24), (16, 0, 0, 24)}


def test_random_texts_against_plain_windows(spark):
    random = np.random.default_rng(0)
    texts = [" ".join(random.choice(list("abc"), n)) for n in random.integers(0, 120, 60)]
    items = [(int(k), " ".join(random.choice(list("abc"), n))) for k, n in enumerate(random.integers(0, 9, 12))]
    items.append((50, texts[3]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(docs, benchmark).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    same(map(tuple, got.collect()), [(i, *brute.contamination(t, items)) for i, t in enumerate(texts)])
    assert benchmark_hits(docs, benchmark).columns[:2] == ["doc_id", "text"]


# -- licenses --------------------------------------------------------------------------


def test_license_places(odd_docs):
    want = []
    for doc_id, text in pairs(odd_docs):
        own = brute.words(text)
        at = [
            (i, label)
            for phrase, label in BASE.items()
            for i in range(len(own))
            if own[i : i + len(phrase.split())] == phrase.split()
        ]
        starts = [i for i, _ in at]
        want.append(
            (doc_id, len(own), len(at), min(starts, default=None), max(starts, default=None),
             ",".join(sorted({label for _, label in at})))
        )
    got = license_scan(odd_docs)
    same(map(tuple, got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()), want)
    row = got.where("doc_id = 12").first()
    assert row["labels"] == "apache,apache-2.0,cc-by" and row["score"] == 1.0
    assert got.where("n_base = 0 and score > 0").count() == 0
    assert license_scan(odd_docs.limit(0)).count() == 0


# -- near copies -----------------------------------------------------------------------


def test_near_groups(odd_docs):
    docs = pairs(odd_docs)
    got = near_groups(odd_docs).select("doc_id", "n_shingles", "component_id")
    same(map(tuple, got.collect()), [(i, *c) for (i, _), c in zip(docs, brute.near_components(docs), strict=True)])
    assert near_groups(odd_docs.limit(0)).count() == 0
    kept = near_deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 4, 5, 6, 7, 9, 10, 12, 13, 14, 15]


def test_near_copies_of_all_sizes(spark):
    """Texts of 9 to 400 words with a few words changed, so that many pairs lie around the threshold."""
    random = np.random.default_rng(2)
    texts = []
    for n in [*range(9, 40), *random.integers(40, 400, 30)]:
        base = [f"w{k}" for k in random.integers(0, 5000, n)]
        for changes in (0, 1, 1, 2, 2, 3, n // 40, n // 25):
            own = list(base)
            for k in random.integers(0, n, changes):
                own[k] = f"c{random.integers(0, 9999)}"
            texts.append(" ".join(own[: n - int(random.integers(0, 2))]))
    docs = list(enumerate(texts))
    got = near_groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(7))
    want = [(i, *c) for (i, _), c in zip(docs, brute.near_components(docs), strict=True)]
    same(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), want)


def test_a_bucket_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr("rootwise.llm.jaccard_join.BLOCK", 8)
    monkeypatch.setattr("rootwise.llm.jaccard_join.HOT_IN_BATCH", 4)
    base = [f"w{k}" for k in range(200)]
    docs = [(i, " ".join([*base[: i * 3], f"x{i}", *base[i * 3 + 1 :]])) for i in range(60)]
    got = near_groups(spark.createDataFrame(docs, "doc_id long, text string"))
    want = [(i, *c) for (i, _), c in zip(docs, brute.near_components(docs), strict=True)]
    same(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), want)


# -- shards ----------------------------------------------------------------------------


def test_shards(odd_docs):
    rows = [r.asDict() for r in balanced_shards(odd_docs, 4).collect()]
    texts = pairs(odd_docs)
    same(
        [(r["doc_id"], r["size"], r["text_crc32"]) for r in rows],
        [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts],
    )
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append((r["slot"], r["doc_id"] if r["doc_id"] is not None else -1, r["size"]))
        assert r["law"] == "bytes" and r["grown_shard"] is None
    ids = []
    for shard in sorted(slots):
        assert [s for s, _, _ in sorted(slots[shard])] == list(range(len(slots[shard])))
        assert sum(size for _, _, size in slots[shard]) <= total / 4 + largest
        ids += [i for _, i, _ in sorted(slots[shard])]
    assert ids == sorted(ids)
    assert balanced_shards(odd_docs.limit(0), 4).count() == 0


# -- packing ---------------------------------------------------------------------------


def check_packing(rows, texts, window):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_vocabulary()["json_path"])
    ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for _, t in texts]
    pieces = Counter()
    sequences = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    want = Counter()
    for (doc_id, _), own in zip(texts, ids, strict=True):
        for start in range(0, len(own), window):
            piece = np.array(own[start : start + window], "<u4")
            want[doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(own)] += 1
    assert pieces == want
    return sum(map(len, ids)) / (len(sequences) * window)


@pytest.mark.parametrize("partitions", [1, 40])
def test_packing(spark, odd_docs, partitions):
    rows = packed(odd_docs.repartition(partitions), **public_vocabulary(), open_windows=3).collect()
    check_packing(rows, pairs(odd_docs), 1024)
    assert packed(odd_docs.limit(0), **public_vocabulary()).count() == 0


def test_packing_leaves_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(50)
    rows = packed(docs, **public_vocabulary()).collect()
    assert check_packing(rows, pairs(docs), 1024) > 0.95


def test_special_texts_have_the_tokenizer_s_ids():
    from tokenizers import Tokenizer

    encoder = Encoder(**public_vocabulary())
    tokenizer = Tokenizer.from_file(public_vocabulary()["json_path"])
    for text in ("a<|endoftext|>b", "　 x  \t\r\n\n y", "don't 're ÉTÉ ﷽ 🙂🏽", "\x00\x01", "1234567890" * 9):
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


# -- quality and language --------------------------------------------------------------


def test_quality_of_odd_rows(odd_docs, few_labels):
    rows = quality_scores(odd_docs, few_labels).collect()
    same([r["doc_id"] for r in rows], [i for i, _ in pairs(odd_docs)])
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        left = None if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode()) % 3
        assert r["held_out"] == (left in (None, 1))
    assert quality_scores(odd_docs.limit(0), few_labels).count() == 0
    assert {r["score"] for r in quality_scores(odd_docs, few_labels.limit(0)).collect() if r["doc_id"] == 5}
    assert of_quality(odd_docs, few_labels).columns == odd_docs.columns


def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality_scores(spark.read.parquet(f"{folder}/documents.parquet"), labels).join(labels, "doc_id")
    rows = scored.where("held_out and quality is not null").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    assert right > 0.95, right


def test_languages_of_odd_rows(odd_docs):
    rows = languages(odd_docs).collect()
    same([r["doc_id"] for r in rows], [i for i, _ in pairs(odd_docs)])
    texts = defaultdict(list)
    for i, t in pairs(odd_docs):
        texts[i].append(t)
    for r in rows:
        assert 0 <= r["score"] <= 1
        if len(texts[r["doc_id"]]) == 1:
            told = any(c.isalpha() for c in texts[r["doc_id"]][0] or "")
            assert r["lang_pred"] == ("en" if told else "und")
    assert languages(odd_docs.limit(0)).count() == 0
    unknown = languages(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in unknown.collect()} == {("und", 0.0)}


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.95


# -- language model --------------------------------------------------------------------


def check_scores(rows, texts):
    tokens = [[*brute.tokens(t), None] for _, t in texts]
    out = [i is None or zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    counts = Counter(w for own, o in zip(tokens, out, strict=True) if not o for w in own)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (repr(i), o, len(own), sum(counts[w] > 0 for w in own), n,
         sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        for (i, _), own, o in zip(texts, tokens, out, strict=True)
    )
    got = sorted(
        (repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows
    )
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


@pytest.mark.parametrize("known", [20, 200_000])
def test_lm_scores_of_odd_rows(odd_docs, monkeypatch, known):
    monkeypatch.setattr("rootwise.llm.lm_scoring.KNOWN_WORDS", known)
    rows = lm_scores(odd_docs).collect()
    check_scores(rows, pairs(odd_docs))
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in rows)
    assert lm_scores(odd_docs.limit(0)).count() == 0


def test_the_model_beats_the_base_score(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lm_scores(docs).collect()
    check_scores(rows, pairs(docs))
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_model_probabilities_sum_to_one():
    from rootwise.llm.gru import Gru

    model = Gru(np.array([5.0, 9, 3, 2, 1, 1, 4]), classes=3)
    model.train([np.array([1, 2, 3, 0]), np.array([2, 2, 6, 0])] * 20, 0.01, lanes=4)
    start = model.score([np.array([1])])[0]
    each = [model.score([np.array([1, k])])[0] - start for k in range(7)]
    assert abs(sum(math.exp(p) for p in each) - 1) < 1e-5


def test_states_are_carried_over_windows():
    from rootwise.llm import gru

    model = gru.Gru(np.ones(9))
    random = np.random.default_rng(1)
    model.to_class = random.normal(0, 1, model.to_class.shape).astype(np.float32)
    text = random.integers(0, 9, 100)
    whole, short = model.score([text, text[:5]])
    gru_window, gru.WINDOW = gru.WINDOW, 200
    try:
        assert abs(model.score([text])[0] - whole) < 1e-3
    finally:
        gru.WINDOW = gru_window
    assert abs(model.score([text[:5]])[0] - short) < 1e-4


# -- exact copies ----------------------------------------------------------------------


@pytest.mark.parametrize("batches", [1, 3])
def test_exact_groups(odd_docs, batches):
    docs = pairs(odd_docs)
    groups = defaultdict(list)
    for i, t in docs:
        groups[brute.normalised(t)].append(i)
    rows = exact_groups(odd_docs, batches).collect()
    want = []
    for i, t in docs:
        own = groups[brute.normalised(t)]
        keep = min((k for k in own if k is not None), default=None)
        want.append((i, keep, len(own), hashlib.sha256(brute.normalised(t).encode()).hexdigest()))
    same([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows], want)
    kept = Counter(r["text_sha256"] for r in rows if r["kept"])
    assert len(kept) == len(groups) and set(kept.values()) == {1}
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
    left = deduplicated(odd_docs, batches)
    assert left.columns == odd_docs.columns and left.count() == len(groups)
    assert exact_groups(odd_docs.limit(0), batches).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 30_000])
def test_filters_hold_their_keys(n):
    random = np.random.default_rng(n)
    keys = random.integers(0, 2**63, n, np.uint64)
    other = random.integers(2**63, 2**64, 20_000, np.uint64)
    built = build_filter(keys)
    assert in_filter(keys, *built).all()
    assert in_filter(other, *built).mean() < 0.02
