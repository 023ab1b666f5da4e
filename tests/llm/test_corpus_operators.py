"""Importance resampling, prefix trie and corpus model against plain versions, on given rows and on odd ones."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cartloom.llm import corpus_model, importance, mixing, prefix_trie
from cartloom.llm.arrays import find_words, ALNUM
from cartloom.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

ODD = [
    (90001, None),
    (90002, ""),
    (90003, " \n\t "),
    (90004, "One"),
    (90005, "eins zwei drei " * 9),
    (90005, "eins zwei drei " * 9),
    (None, "word without an id " * 6),
    (None, None),
    (90007, "É" * 5000 + " " + "x" * 300 + " x"),
    (-7, "the same words again and again " * 3000),
]


@pytest.fixture(scope="module")
def rows(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in given] + ODD


@pytest.fixture(scope="module")
def docs(spark, rows):
    # Extra columns whose names clash with the operators' own.
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, rank int, slice string").repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def buckets(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def some(values):
    return sorted(values, key=lambda v: [(x is not None, x) for x in v])


def test_importance(spark, docs, rows, none):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("text")
    items = items.unionByName(spark.createDataFrame([(None,), ("",)], "text string"))
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text))
    for (text,) in items.collect():
        t.update(buckets(text))
    total, wanted = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * total / ((s[b] + 1) * wanted))) for b in range(10000)]
    expected, able = [], []
    for doc, text in rows:
        found = buckets(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        expected.append((doc, len(found), weight, score))
        if len(words(text)) >= 20:
            able.append((-score, doc is None, doc, len(found), weight, score))
    drawn = sorted(able)[: 5 * len(able) // 100]
    out = importance.resample(docs, items).collect()
    assert some(tuple(r)[:4] for r in out) == some(expected)
    ranked = sorted((r for r in out if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1)) and drawn
    assert [r["doc_id"] for r in ranked] == [d[2] for d in drawn]
    assert importance.resample(none, items).count() == 0
    assert importance.resample(docs, none).count() == len(rows)


def test_importance_ties_go_to_the_smaller_id(spark):
    text = "one two three four five six seven eight nine ten " * 2
    docs = spark.createDataFrame([(1, text)] * 200, "doc_id long, text string")
    out = importance.resample(docs, docs.select("text")).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 11)) and len({r["score"] for r in out}) == 1


def test_feature_hashes_of_long_words():
    text = ("a" * 63 + " " + "b" * 64 + " " + "c" * 65 + " " + "d" * 70000 + " É " + "e" * 130).encode()
    data = np.frombuffer(text, np.uint8)
    _, row, bucket = importance.features(data, np.array([0, len(data)]))
    assert sorted(bucket.tolist()) == sorted(buckets(text.decode()))
    assert len(find_words(data, np.array([0, len(data)]), ALNUM).row) == 6


def test_bit_planes_are_exact():
    rng = np.random.default_rng(3)
    gain = rng.integers(-30000, 30000, importance.BUCKETS)
    row = rng.integers(0, 7, 5000)
    bucket = rng.integers(0, 50, 5000) ** 2
    bucket[:900], row[:900] = 17, 3
    found = importance.weights(row, bucket, 8, importance.gain_planes(gain))
    assert found.tolist() == [int(gain[bucket[row == r]].sum()) for r in range(8)]


def plain_trie(rows):
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            conv[c].append((turn is not None, turn or 0, role or "", text or ""))
    conv = {c: [v[2:] for v in sorted(vs)] for c, vs in conv.items()}
    full = {}
    for c, v in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = conv.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[tuple(full[c][:d])].append(c)
        ends[tuple(full[c])].append(c)
    kids, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for k, m in members.items():
        own = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += own
            leaves[k[:d]] += k not in kids
    return [
        (m[0], len(k), members[k[:-1]][0] if k else None, len(m), kids[k], leaves[k], saved[k],
         hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest())
        for k, m in members.items()
    ]


def test_prefix_trie(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = [
        (None, 0, "user", "lost"),
        (5000, None, "user", "first"), (5000, 0, None, None), (5000, 1, "a", ""), (5000, 1, "a", ""),
        *((c, t, "user", "same words") for c in range(5001, 5020) for t in range(3)),
        (5041, 0, "user", "without a head"), (5041, 1, "user", "b"), (5043, 0, "u", "c"),
        (-3, 0, "user", "below zero"), (-41, 0, "user", "below zero"), (-40, 0, "user", "below zero"),
        *((9000 + 2 * c, t, "x", f"turn {t}") for c in range(4) for t in range(150 + c % 2)),
        (9999999, 0, "user", "x " * 50000),
    ]
    extra = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")
    both = given.unionByName(extra).selectExpr("*", "'x' AS node", "1 AS depth").repartition(5)
    found = prefix_trie.prefix_trie(both)
    expected = plain_trie([tuple(r) for r in given.collect()] + odd)
    assert some(tuple(r) for r in found.collect()) == some(expected)
    assert prefix_trie.prefix_trie(given.limit(0)).count() == 0


@pytest.mark.parametrize("size, window", [(20, 2), (40, 1), (10**9, 64)])
def test_prefix_trie_over_shards_and_windows(spark, monkeypatch, size, window):
    monkeypatch.setattr(prefix_trie, "SHARD", size)
    monkeypatch.setattr(prefix_trie, "WINDOW", window)
    rng = np.random.default_rng(5)
    odd = [(int(c), int(t), "r", f"w{rng.integers(2)}") for c in range(120) for t in range(rng.integers(1, 7))]
    found = prefix_trie.prefix_trie(spark.createDataFrame(odd, "conv_id long, turn long, role string, text string"))
    assert some(tuple(r) for r in found.collect()) == some(plain_trie(odd))


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def test_corpus_model_counts(docs, rows, none):
    tokens = [(d, re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None]) for d, t in rows]
    counts = Counter(w for d, ws in tokens if not held(d) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    expected = [
        (d, held(d), len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws))
        for d, ws in tokens
    ]
    found = corpus_model.score_documents(docs).collect()
    a, b = some(tuple(r)[:6] for r in found), some(expected)
    assert [x[:5] for x in a] == [x[:5] for x in b]
    assert np.allclose([x[5] for x in a], [x[5] for x in b], rtol=1e-9)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)
    same = {r["score"] for r in found if r["doc_id"] == 90005}
    assert len(same) == 1
    assert corpus_model.score_documents(none).count() == 0


def test_corpus_model_predicts_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    out = corpus_model.score_documents(docs).where("held_out").collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    train = Counter(b for d, t in texts.items() if not held(d) for b in t + b"\xff")
    n = sum(train.values())
    size = sum(len(texts[r["doc_id"]]) + 1 for r in out)
    plain = -sum(math.log2((train[b] + 1) / (n + 256)) for r in out for b in texts[r["doc_id"]] + b"\xff") / size
    mixed = -sum(r["score"] for r in out) / math.log10(2) / size
    assert mixed < 0.65 * plain


def plain_bits(text, odds, code):
    """The mixture of one text, one bit at a time."""
    data = np.frombuffer(text, np.uint8)
    full, offsets = mixing.with_ends(data, np.array([0, len(data)]))
    base, spent = mixing.contexts(full, offsets), 0.0
    for at, byte in enumerate(full.tolist()):
        if at % mixing.SEGMENT == 0:
            weights = np.full((2, mixing.CONTEXTS), mixing.WEIGHT * float(mixing._SCALE))
        node = 1
        for k, bit in enumerate(map(int, format(code.word[byte], f"0{code.length[byte]}b"))):
            slot = mixing.slots(base[:, at : at + 1], np.array([node], np.uint32))[:, 0]
            x = odds[min(k, mixing.PLACES - 1)][slot].astype(float)
            w = weights[0 if x[-1] else 1]
            p = 1 / (1 + math.exp(-max(-8, min(8, float(w @ x)))))
            spent -= math.log2(p if bit else 1 - p)
            w += x * (bit - p) * float(mixing.RATE)
            node = 2 * node + bit
    return spent


def test_mixing_against_one_bit_at_a_time():
    texts = [b"", b"a", "Grüße an alle, grüße an alle".encode(), b"the cat and the dog " * 60, b"x" * 1200]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    full, _ = mixing.with_ends(data, offsets)
    code = mixing.code_of(np.bincount(full, minlength=256))
    counts = np.zeros((mixing.PLACES, 2 * mixing.CONTEXTS << mixing.BITS), np.int64)
    mixing.count(counts, data, offsets, code)
    assert counts.sum() == mixing.CONTEXTS * code.length[full].sum()
    odds = mixing.log_odds(counts.reshape(mixing.PLACES, -1, 2))
    together = mixing.bits_of(data, offsets, odds, code)
    for text, bits in zip(texts, together):
        alone = mixing.bits_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]), odds, code)[0]
        assert abs(alone - bits) < 1e-9
        assert abs(alone - plain_bits(text, odds, code)) < 1e-3 * (1 + bits)


def test_the_mixture_is_learnt_from_training_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    training = docs.where(~corpus_model.held_out(docs["doc_id"])).select("text")
    code = mixing.code_of(corpus_model.byte_counts(training))
    odds, weights = corpus_model.learnt(training, code)
    start = mixing.Mixer().weights
    assert weights.shape == start.shape and (np.abs(weights - start) > 0.1 * start).any()
    texts = [(r["text"] or "").encode() for r in docs.where(corpus_model.held_out(docs["doc_id"])).collect()]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    assert mixing.bits_of(data, offsets, odds, code, weights).sum() < 0.999 * mixing.bits_of(data, offsets, odds, code).sum()


def test_bits_are_predicted_before_they_are_counted():
    text = b"the cat and the dog and the bird " * 400
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    full, _ = mixing.with_ends(data, offsets)
    code, shape = mixing.code_of(np.bincount(full, minlength=256)), (mixing.PLACES, 2 * mixing.CONTEXTS << mixing.BITS)
    plain, counts, mixer = np.zeros(shape, np.int64), np.zeros(shape, np.int64), mixing.Mixer()
    mixing.count(plain, data, offsets, code)
    nothing = mixing.log_odds(counts.reshape(mixing.PLACES, -1, 2))
    mixing.learn(counts, nothing, mixer, data, offsets, code)
    assert (counts == plain).all() and (mixer.weights == mixing.Mixer().weights).all()
    odds = mixing.log_odds(counts.reshape(mixing.PLACES, -1, 2))
    mixing.learn(counts, odds, mixer, data, offsets, code)
    assert (counts == 2 * plain).all() and (mixer.weights > mixing.Mixer().weights).any()
    assert np.allclose(mixing.together([(mixer.weights, mixer.curvature)] * 2), mixer.weights)
    assert mixing.bits_of(data, offsets, odds, code, mixer.weights)[0] < mixing.bits_of(data, offsets, odds, code)[0]


def test_log_odds_of_few_and_many_counts():
    counts = np.array([[0, 0], [1, 0], [254, 3], [255, 255], [3, 256], [10**9, 7]])
    exact = np.rint(12 * np.log((counts[:, 1] + 0.4) / (counts[:, 0] + 0.4))).clip(-127, 127)
    assert (mixing.log_odds(counts) == exact).all()


@pytest.mark.parametrize("distinct", [1, 200, 60_000, 70_000, 1 << 25])
def test_places_of_words_come_back(distinct):
    place = np.random.default_rng(distinct).integers(0, distinct, 500)
    parts = corpus_model._packed(place, np.array([0, 0, 3, 500]), distinct)
    back = [corpus_model._unpacked(pa.py_buffer(p), n) for p, n in zip(parts, (0, 3, 497))]
    assert (np.concatenate(back) == place).all()


@pytest.mark.parametrize("counts", [[0] * 256, [2**i if i < 60 else 0 for i in range(256)], [10**15] + [0] * 255])
def test_words_of_bytes_are_a_whole_prefix_code(counts):
    code = mixing.code_of(np.array(counts, dtype=object))
    words = sorted(format(w, f"0{n}b") for w, n in zip(code.word, code.length))
    assert not any(b.startswith(a) for a, b in zip(words, words[1:]))
    assert sum(2.0 ** -int(n) for n in code.length) == 1 and code.length.max() <= mixing.LONGEST
    assert code.length[np.argmax(counts)] == code.length.min()


def test_contexts_depend_on_the_text_before_alone():
    a, b = b"one two three", b"zz two three"
    data = np.frombuffer(a + b + a, np.uint8)
    base = mixing.contexts(data, np.array([0, len(a), len(a) + len(b), len(data)]))
    assert (base[:, : len(a)] == base[:, len(a) + len(b) :]).all()
    alone = mixing.contexts(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
    assert (alone == base[:, len(a) : len(a) + len(b)]).all()
    assert (base[1, 8:13] == alone[1, 7:12]).all() and (base[2, 3:7] != alone[2, 2:6]).all()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) == []
