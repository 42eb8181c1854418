"""The stages of the corpus pipeline, each on what its predecessor kept."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
from funnelwright.llm.neardup import near_duplicates

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{number}")
        out = spark.read.parquet(f"{tmp_path}/{number}")
        assert out.columns == columns or number == len(corpus_pipeline.STAGES) - 1
        if number == 1:
            assert near_duplicates(out).filter("NOT kept").count() == 0
        docs = out
    final = corpus_pipeline.run(spark, SF)
    assert sorted(final.select("doc_id", "shard").collect()) == sorted(docs.select("doc_id", "shard").collect())


# Each stage against a plain recomputation, on test documents with planted cases.

BENCHMARK = "one passage of some thirty words that only the benchmark has and that no document should hold when training begins because scores would then tell how well it was learnt by heart"


def planted(spark):
    draw = random.Random(6)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    plain = [r for r in rows if r[1] and len(r[1].split()) > 60][:60]
    words = BENCHMARK.split()
    docs = [(*r, draw.choice("aaaaaabc")) for r in plain]
    docs += [(100_000 + i, r[1], r[2], "d") for i, r in enumerate(plain[:5])]  # copies
    docs += [(200_000 + i, r[1] + " " + "tail", r[2], "a") for i, r in enumerate(plain[5:10])]  # near copies
    docs += [(300_000, "1234 -- 5678", "en", "a"), (300_001, "", "en", "a"), (300_002, None, None, None), (300_003, "это было когда время город " * 20, None, "b")]
    start = [" ".join(r[1].split()[:45]) for r in plain[11:13]]
    docs += [(400_000, f"{start[0]} {BENCHMARK.upper()}", plain[11][2], "a"), (400_001, f"{start[1]} {' '.join(words[:9] + ['x'] + words[10:])}", plain[12][2], "c")]
    docs += [(500_000 + i, " ".join(draw.sample(plain[20 + i][1].split(), 50)), plain[20 + i][2], None) for i in range(4)]
    docs.append(docs[0])
    frame = spark.createDataFrame([(*r, len(r[1] or ""), 777) for r in docs], "doc_id long, text string, lang string, source string, n_chars long, _size int")
    return frame.repartition(4)


def plain_near_duplicates(rows):
    shingles = {}
    for doc_id, text in rows:
        words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
        shingles[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in shingles}
    for a, b in itertools.combinations(sorted(shingles), 2):
        both, either = len(shingles[a] & shingles[b]), len(shingles[a] | shingles[b])
        if either and 100 * both >= 80 * either:
            one, other = sorted((root[a], root[b]))
            root = {i: one if r == other else r for i, r in root.items()}
    return {i for i, r in root.items() if i == r}


def plain_leaks(rows, item):
    item, found = item.lower().split(), set()
    for doc_id, text in rows:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        for first in range(len(item) - 19):
            for start in range(len(words) - 19):
                if sum(a == b for a, b in zip(item[first : first + 20], words[start : start + 20])) >= 16:
                    found.add(doc_id)
    return found


def plain_mix(rows):
    """How often each row is taken."""
    size = {s: sum(len((t or "").split()) for _, t, own in rows if own == s) for _, _, s in rows}
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), float(sum(size.values()))
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * size[s] <= level * weight[s]}
        for s in full or open_:
            target[s] = 3.0 * size[s] if full else level * weight[s]
            rest -= target[s]
        open_ -= full or open_
    taken = Counter()
    for s in names:
        epochs = int(target[s] // size[s]) if size[s] else 0
        units = defaultdict(list)
        for row in rows:
            if row[2] == s:
                words = (row[1] or "").split()
                quality = 0.25 + 0.75 * len(set(words)) / len(words) if words else 0.25
                mark = hashlib.md5(f"{row[0]}:{row[1] or ''}".encode()).hexdigest()
                units[-math.log((int(mark[:13], 16) + 0.5) / 2**52) / quality, mark].append(row)
        before = 0
        for key in sorted(units):
            words = sum(len((t or "").split()) for _, t, _ in units[key])
            more = before + words / 2 <= target[s] - epochs * size[s]
            before += words
            taken[units[key][0][0]] += (epochs + more) * len(units[key])
    return +taken


def plain_shards(rows, shards=40):
    """The shard of each document: by order of two hashes, in equal parts of bytes; copies go with the first of them."""
    keys = {}
    for doc_id, text in rows:
        high, low = (int(hashlib.md5(x.encode()).hexdigest()[:15], 16) for x in (text or "", str(doc_id)))
        keys.setdefault((high, low), (doc_id, []))[1].append(len((text or "").encode()) + 16)
    total, before, found = sum(sum(sizes) for _, sizes in keys.values()), 0, {}
    for _, (doc_id, sizes) in sorted(keys.items()):
        found[doc_id] = before * shards // total
        before += sum(sizes)
    return found


def test_stages_equal_a_plain_recomputation(spark, tmp_path):
    docs = planted(spark)
    benchmark = spark.createDataFrame([(1, BENCHMARK)], "item_id long, text string")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = [stage for _, stage in corpus_pipeline.STAGES]

    def run(number, frame):
        stages[number](spark, frame, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        out = spark.read.parquet(f"{tmp_path}/{number}")
        assert out.columns == docs.columns + (["shard"] if number == 4 else [])
        assert out.filter("_size != 777").isEmpty()
        return out

    ids = lambda frame: sorted(r.doc_id for r in frame.select("doc_id").collect())
    rows = lambda frame, *names: [tuple(r) for r in frame.select(*names).collect()]

    spoken = run(0, docs)
    assert Counter(ids(spoken)) == Counter(ids(docs)) - Counter([300_000, 300_001, 300_002, 300_003])
    alone = run(1, spoken)
    kept = plain_near_duplicates(rows(spoken, "doc_id", "text"))
    assert Counter(ids(alone)) == Counter(i for i in ids(spoken) if i in kept)
    assert not {100_000, 200_000} & kept and {400_000, 400_001} <= kept
    clean = run(2, alone)
    leaks = plain_leaks(rows(alone, "doc_id", "text"), BENCHMARK)
    assert leaks == {400_000, 400_001} and ids(clean) == [i for i in ids(alone) if i not in leaks]
    mixed = run(3, clean)
    taken = plain_mix(rows(clean, "doc_id", "text", "source"))
    assert Counter(ids(mixed)) == taken
    assert len(set(taken.values())) > 1 and set(ids(clean)) - set(taken)  # some repeated, one source thinned out
    sharded = run(4, mixed)
    shards = plain_shards(rows(mixed, "doc_id", "text"))
    assert Counter(rows(sharded, "doc_id", "shard")) == Counter((i, shards[i]) for i in ids(mixed))


def test_stages_over_little(spark, tmp_path):
    """No rows, no labels, a few rows, NULLs throughout: no stage fails, and columns stay."""
    spark.createDataFrame([(1, BENCHMARK), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    few = [(1, "Plain words stand here.", None, "a", 1), (2, "Other ones stand there.", None, "a", 1), (2, "Other ones stand there.", None, None, 1)]
    cases = [[], [(None, None, None, None, None)] * 3, few, [(i, text, "en", "a", 0) for i, (_, text, *_) in enumerate(few)]]
    for case, data in enumerate(cases):
        docs = spark.createDataFrame(data, kind)
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{case}-{number}")
            docs = spark.read.parquet(f"{tmp_path}/{case}-{number}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard"]
        assert (docs.count() > 0) == (case > 1)
