"""Resampling, spelling variants and packing, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from funnelwright.llm import packing, resampling, spelling
from funnelwright.llm.common import read_documents

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "x" * 400_000
ODD = [
    (None, None, "a"), (None, "", "a"), (1, "one two", "a"), (1, "one two", "a"), (1, "other words", "b"), (2, " \n ", None),
    (3, "word, " * 200_000, "c"), (4, LONG, "c"), (5, f"{LONG} and {LONG}y", "c"), (6, "éà ÀÉ 東京 <|endoftext|> don't DON'T A1b2", "d"),
]


def odd(spark):
    """Odd rows, and a column for every name that the operators use inside."""
    names = ["data", "n_features", "score", "rank", "word", "run", "id", "key", "part", "nth", "piece", "bucket", "before", "above"]
    docs = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    return docs.select("*", *[F.lit("mine").alias(name) for name in names])


# Resampling


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])], len(words)


def plain_resampling(docs, target, n_buckets, least_words, percent, seed):
    bucket = lambda feature: zlib.crc32(feature.encode()) % n_buckets
    corpus = Counter(bucket(x) for _, text in docs for x in plain_features(text)[0])
    wanted = Counter(bucket(x) for text in target for x in plain_features(text)[0])
    S, T = corpus.total(), wanted.total()
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (S + n_buckets) / ((corpus[b] + 1) * (T + n_buckets)))) for b in range(n_buckets)]
    rows = []
    for doc_id, text in docs:
        features, n_words = plain_features(text)
        weight = sum(gain[bucket(x)] for x in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n_words))
    order = sorted((r for r in rows if r[4] >= least_words), key=lambda r: (-r[3], r[0] is not None, r[0], r[1], r[2]))
    drawn = order[: percent * len(order) // 100]
    return Counter((*r[:4], n) for n, r in enumerate(drawn, 1)) + Counter((*r[:4], None) for r in rows) - Counter((*r[:4], None) for r in drawn)


@pytest.mark.parametrize("scan_bytes", [30, 2_000_000])
def test_resampling_equals_brute_force(spark, monkeypatch, scan_bytes):
    monkeypatch.setattr(resampling, "SCAN_BYTES", scan_bytes)
    monkeypatch.setattr(resampling, "LONGEST_KEY", 9)
    draw = random.Random(3)
    vocabulary = ["a", "The", "café", "東京", "x1", "extraordinarily", "no", "yes", "Ünsal", "b" * 40]
    join = [" ", "  ", ", ", "\n", "-", "'"]
    docs = [(i, "".join(draw.choice(vocabulary) + draw.choice(join) for _ in range(draw.randrange(0, 40)))) for i in range(300)]
    docs += [(7, docs[7][1]), (8, "again"), (301, None), (302, "")]
    target = [docs[i][1] for i in range(0, 40)] + [None]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    wanted = spark.createDataFrame([(text,) for text in target], "text string")
    found = resampling.resample(frame, wanted, n_buckets=97, least_words=5, percent=40, seed=11)
    assert Counter(map(tuple, found.collect())) == plain_resampling(docs, target, 97, 5, 40, 11)


def test_resampling_draws_what_looks_like_the_target(spark):
    draw = random.Random(5)
    words = {kind: [f"{kind}{i}" for i in range(50)] for kind in "ab"}
    docs = [(i, " ".join(draw.choices(words["ab"[i % 2]], k=30))) for i in range(400)]
    target = spark.createDataFrame([(" ".join(draw.choices(words["b"], k=30)),) for _ in range(400)], "text string")
    found = resampling.resample(spark.createDataFrame(docs, "doc_id long, text string"), target).filter("rank IS NOT NULL").collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 101))
    assert sum(r.doc_id % 2 for r in found) >= 95


def test_crc_of_joined_texts():
    operators = resampling._appending_operators()
    draw = random.Random(1)
    pairs = [(draw.randbytes(draw.randrange(0, 9)), draw.randbytes(draw.choice([0, 1, 7, 300, 70_001]))) for _ in range(60)]
    crc = lambda texts: np.array([zlib.crc32(x) for x in texts], np.uint32)
    joined = resampling._joined_crc(operators, crc([a for a, _ in pairs]), crc([b for _, b in pairs]), np.array([len(b) for _, b in pairs]))
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_resampling_odd_rows(spark):
    found = resampling.resample(odd(spark), odd(spark).limit(0), least_words=2, percent=100)
    texts = [(doc_id, text) for doc_id, text, _ in ODD]
    assert Counter(map(tuple, found.collect())) == plain_resampling(texts, [], resampling.BUCKETS, 2, 100, resampling.SEED)
    assert resampling.resample(odd(spark).limit(0), odd(spark)).count() == 0
    assert resampling.resample(odd(spark), odd(spark), least_words=10**9).filter("rank IS NOT NULL").isEmpty()


# Spelling variants


def plain_variants(counts, ratio=10):
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    by_size = defaultdict(list)
    for word in counts:
        by_size[len(word)].append(word)
    found = {}
    for word, n in counts.items():
        others = [x for size in (-1, 0, 1) for x in by_size[len(word) + size] if near(word, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        found[word] = (n, len(others), best if best and counts[best] >= ratio * n else None)
    rows = set()
    for word, (n, n_near, form) in found.items():
        root = word
        while found[root][2]:
            root = found[root][2]
        rows.add((word, n, n_near, form, counts[form] if form else None, root))
    return rows


@pytest.mark.parametrize("long_word", [1, 4, 5, 64])
def test_variants_equal_brute_force(spark, long_word):
    draw = random.Random(long_word)
    words = {"".join(draw.choices("aabé", k=draw.randrange(2, 8))) for _ in range(500)}
    counts = {word: draw.choice([2, 2, 3, 20, 30, 200, 300, 3000]) for word in sorted(words)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    found = spelling.group_variants(frame, long_word=long_word)
    assert {tuple(r) for r in found.select("word", "n", "n_near", "form", "form_n", "root").collect()} == plain_variants(counts)
    assert found.count() == len(counts)


def test_variants_of_a_frequent_word(spark):
    hub = "frequently"
    variants = {hub[:i] + c + hub[i:] for i in range(len(hub) + 1) for c in "abcdefghijklmnopqrstuvwxyzé"} - {hub}
    counts = {hub: 5000} | dict.fromkeys(sorted(variants), 3)
    found = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert {r.root for r in found} == {hub}
    assert {tuple(r) for r in found} == plain_variants(counts)


def test_counted_words_equal_brute_force(spark):
    docs = read_documents(spark, SF)
    expected = Counter()
    for doc_id, text in docs.select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            word = run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]
            expected[word] += len(word) >= 7
    assert {r.word: r.n for r in spelling.count_words(docs).collect()} == {w: n for w, n in expected.items() if n >= 2}


def test_variants_odd_rows(spark):
    found = {r.word: r for r in spelling.spelling_variants(odd(spark).unionAll(odd(spark))).collect()}
    assert not spelling.spelling_variants(odd(spark).limit(0)).collect()
    assert max(map(len, found)) >= len(LONG) - 1
    counts = Counter()
    for doc_id, text, _ in ODD * 2:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            word = run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    assert {r.word: r.n for r in found.values()} == counts
    assert {w: found[w].n_near for w in counts} == {w: sum(abs(len(w) - len(x)) == 1 for x in counts if "x" in x) if "x" in w else 0 for w in counts}


# Packing


def plain_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path(packing.TOKENIZER))
    tokenizer.encode_special_tokens = True
    return [[*encoding.ids, packing.END_ID] for encoding in tokenizer.encode_batch([text or "" for text in texts], add_special_tokens=False)]


def check_packing(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        spot = 0
        for offset, length in sorted(places):
            assert offset == spot and length > 0
            spot += length
        assert spot <= capacity
    return len(by_sequence)


def plain_pieces(docs, capacity):
    return Counter(
        (doc_id, k // capacity, k, len(ids[k : k + capacity]), zlib.crc32(np.array(ids[k : k + capacity], "<u4").tobytes()))
        for (doc_id, _), ids in zip(docs, plain_ids([text for _, text in docs]))
        for k in range(0, len(ids), capacity)
    )


@pytest.mark.parametrize("capacity", [100, 4096])
def test_packing_of_the_documents(spark, capacity):
    docs = [tuple(r) for r in read_documents(spark, SF).select("doc_id", "text").collect()]
    rows = packing.pack(read_documents(spark, SF).repartition(7), capacity=capacity).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == plain_pieces(docs, capacity)
    assert check_packing(rows, capacity) <= 1.005 * sum(r.length for r in rows) / capacity + 1


@pytest.mark.parametrize("split_bytes", [3, 10, 2_000_000])
def test_packing_odd_rows(spark, monkeypatch, split_bytes):
    rows_in = ODD if split_bytes > 10 else [row for row in ODD if len(row[1] or "") < 100]
    rows_in = rows_in + [(9, "é. J̌ H̱= ≠ İ İ Σ ΑΣ, x y z a̸b K", "e"), (10, "'star it's'll 12ab34 ½a ªb", "e")]
    monkeypatch.setattr(packing, "SPLIT_BYTES", split_bytes)
    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    docs = spark.createDataFrame(rows_in, "doc_id long, text string, source string").withColumn("length", F.lit("mine"))
    rows = packing.pack(docs, capacity=64).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == plain_pieces([r[:2] for r in rows_in], 64)
    check_packing(rows, 64)
    assert packing.pack(odd(spark).limit(0)).count() == 0


def fewest(lengths, capacity):
    """The least number of sequences, by trying all."""
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def place(k, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if k == len(lengths):
            best = len(gaps)
            return
        for gap in {gap for gap in gaps if gap >= lengths[k]}:
            i = gaps.index(gap)
            place(k + 1, [*gaps[:i], gap - lengths[k], *gaps[i + 1 :]])
        place(k + 1, [*gaps, capacity - lengths[k]])

    place(0, [])
    return best


def test_plan_uses_all_pieces_and_few_sequences():
    draw, more, all_of_them = random.Random(2), 0, 0
    for _ in range(150):
        capacity = draw.choice([10, 16, 30])
        lengths = [draw.randint(1, capacity) for _ in range(draw.randrange(0, 11))]
        plan = packing.plan_sequences(np.bincount(lengths, minlength=capacity + 1) if lengths else np.zeros(capacity + 1, int))
        assert Counter(x for times, own in plan for x in own * times) == Counter(lengths)
        assert all(sum(own) <= capacity for _, own in plan)
        least, n = fewest(lengths, capacity), sum(times for times, _ in plan)
        assert least <= n <= least + 1
        more, all_of_them = more + n - least, all_of_them + least
    assert more <= 0.03 * all_of_them


def test_index_of_sums_stays_right():
    draw = random.Random(4)
    counts = np.array([0] + [draw.choice([0, 0, 1, 2, 3]) for _ in range(40)])
    stock = packing._Stock(counts)
    while stock.left.any():
        length = int(draw.choice(np.flatnonzero(stock.left)))
        stock.take(length, draw.randint(1, int(stock.left[length])))
        held = stock.left
        pairs = [sum(1 for a in range(1, s // 2 + 1) if held[a] and held[s - a] and (2 * a != s or held[a] > 1)) for s in range(41)]
        assert stock.pairs.tolist() == pairs
        for gap in range(1, 41):
            exact = stock.exactly(gap)
            assert sum(exact) in (0, gap) and all(held[x] >= n for x, n in Counter(exact).items())
            triples = any(held[a] and held[b] and held[gap - a - b] and all(held[x] >= n for x, n in Counter((a, b, gap - a - b)).items())
                          for a in range(1, gap) for b in range(1, gap - a))
            assert bool(exact) == bool(held[gap] or pairs[gap] or triples)


def test_hot_lengths_are_dealt_by_task(spark):
    docs = spark.range(0, 5_000, 1, 9).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").alias("text"))
    rows = packing.pack(docs, capacity=50).collect()
    sizes = Counter(r.length for r in rows)
    assert len(sizes) == 2
    assert check_packing(rows, 50) <= -(-sum(r.length for r in rows) // 50) + 1
