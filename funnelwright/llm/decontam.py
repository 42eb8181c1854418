"""Benchmark passages in documents, found by spaced seeds and verified with substitutions. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelwright.llm.common import Scratch

LEAST_WORDS = 4  # of an item that is looked for
WINDOW = 20  # words that are compared, or the whole item where it is shorter
EQUAL = 80  # percent of these that have to agree
SEEDS_PER_BLOCK = 200_000  # of benchmark seeds that are sent to all tasks at once
WINDOWS_PER_PART = 1_000  # of an item; longer items are cut
# Characters of scripts without spaces between words (Thai to Khmer, kana, Han): each is a word.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
TOKEN = rf"[{UNSPACED}]|[\p{{L}}\p{{N}}&&[^{UNSPACED}]]+"


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; in scripts without spaces each character."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))


def mask(compared: int) -> str:
    """The mask for windows of so many words: "1" for a word that the seed has, "0" for one that it ignores.

    A window that counts has at most so many unequal words; the seed has every further word than that. Put to the window's first
    words in turn, the mask's ones fall into as many classes as there may be unequal words and one more, and share no word. So
    one class has none of the unequal words, whichever they are, and its seed hits.
    """
    unequal = compared * (100 - EQUAL) // 100
    return ("0" * unequal).join(["1"] * (compared // (unequal + 1)))


def _seed(own_mask: str, own: str, at: Column) -> Column:
    """The hash of the mask and of the words under its ones, from position ``at``."""
    return F.xxhash64(F.lit(own_mask), *[F.get(F.col(own), at + place) for place, bit in enumerate(own_mask) if bit == "1"])


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Benchmark items that documents contain: (doc_id, item_id, matched, compared, doc_start), a row per pair.

    A document contains an item if ``WINDOW`` adjoining words of it (all, if it has fewer) agree in place with the document
    for at least ``EQUAL`` percent. Told is the best window, the first among equals, with ``doc_start``, its first word in
    the document.

    Seeds are hashes of the words under a fixed mask that ignores the positions in between, see :func:`mask`. Every position
    of every document gives a seed per mask that items need; those equal to an item's are hits, and the windows around them are
    compared word by word. No window that counts is missed, whatever words of it are unequal.

    Items are cut into parts of ``WINDOWS_PER_PART`` windows and go to all tasks in blocks of about ``SEEDS_PER_BLOCK`` seeds, so
    what is sent is bounded; the documents are read once per block. They are never shuffled, and a passage that many documents share
    costs a row each. A task holds all hits of a document at once, so a hit has the words around it, not those of the whole document,
    and stands for all windows that share its seed. Items of fewer than ``least_words`` words are not looked for: with one, a document
    that has the only word of an item contains it.

    Defined cases: NULL and empty texts contain nothing. Documents that share a doc_id, or items that share an item_id,
    are reported as one, and NULL ids as one. Equal items are found each. Extra columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    items = benchmark.select(F.col(item_id).alias("item_id"), tokens(F.col(item_text)).alias("item")).distinct()
    items = items.filter(F.size("item") >= max(1, least_words)).withColumn("compared", F.least(F.size("item"), F.lit(WINDOW)))
    last = F.floor((F.size("item") - F.col("compared")) / WINDOWS_PER_PART).cast("int")
    items = items.withColumn("part", F.explode(F.sequence(F.lit(0), last)))
    part = F.slice("item", F.col("part") * WINDOWS_PER_PART + 1, F.lit(WINDOWS_PER_PART - 1) + F.col("compared"))
    items = scratch.store(items.select("item_id", F.xxhash64("item_id", "item", "part").alias("number"), part.alias("item"), "compared"), "items")
    masks = {size: mask(size) for size in sorted(items.agg(F.collect_set("compared")).first()[0])}
    unequal = F.floor(F.col("compared") * (100 - EQUAL) / 100).cast("int")
    # A window has a seed at its first word and at as many next ones as it may have unequal words.
    n_seeds = items.agg(F.sum(F.size("item") - F.col("compared") + 1 + unequal)).first()[0] or 0
    blocks = max(1, -(-n_seeds // SEEDS_PER_BLOCK))
    kinds = sorted(set(masks.values())) or [mask(LEAST_WORDS)]
    least = min(map(len, kinds))

    source = docs.select(F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("words"))
    # Not a filter, for which Spark would look for the words once more.
    places = F.when(F.size("words") >= least, F.sequence(F.lit(0), F.size("words") - least))
    starts = source.withColumn("at", F.explode(places))
    hashed = starts.select("doc_id", "words", "at", F.stack(F.lit(len(kinds)), *[_seed(kind, "words", F.col("at")) for kind in kinds]).alias("seed"))
    found = []
    for block in range(blocks):
        own = items.filter(F.pmod("number", F.lit(blocks)) == block)
        last_place = F.size("item") - F.col("compared") + unequal
        seeds = own.withColumn("place", F.explode(F.sequence(F.lit(0), last_place)))
        seed = F.coalesce(*[F.when(F.col("compared") == size, _seed(kind, "item", F.col("place"))) for size, kind in masks.items()], F.lit(None))
        seeds = seeds.select("number", "place", "compared", seed.alias("seed"))
        hits = hashed.join(F.broadcast(seeds), "seed")
        # The words of all windows that have this seed; none of them begins more than the allowed unequal words before it.
        begin = F.greatest(F.lit(0), F.col("at") - unequal)
        around = F.slice("words", begin + 1, F.col("at") - begin + F.col("compared"))
        hits = hits.select("doc_id", "number", "place", "at", begin.alias("begin"), around.alias("around"))
        hits = hits.join(F.broadcast(own), "number")
        firsts = F.sequence(F.greatest(F.lit(0), F.col("place") - unequal), F.least("place", F.size("item") - F.col("compared")))
        best = F.array_max(F.transform(firsts, _window_from)).alias("best")
        found.append(hits.select("doc_id", "item_id", best))
    hits = found[0]
    for more in found[1:]:
        hits = hits.union(more)
    verified = hits.filter(F.col("best.matched") * 100 >= F.col("best.compared") * EQUAL)
    best = F.max("best").alias("best")
    told = verified.groupBy("doc_id", "item_id").agg(best)
    return told.select("doc_id", "item_id", "best.matched", "best.compared", (-F.col("best.start")).alias("doc_start"))


def _window_from(first: Column) -> Column:
    """The item's window from ``first``, put where a hit says, as (matched, start, compared); ``start`` is negative for the first to be the best."""
    doc_start = F.col("at") - F.col("place") + first
    equal = F.aggregate(
        F.sequence(F.lit(0), F.col("compared") - 1),
        F.lit(0),
        lambda n, i: n + F.coalesce((_word("around", doc_start - F.col("begin") + i) == _word("item", first + i)).cast("int"), F.lit(0)),
    )
    return F.struct(equal.alias("matched"), (-doc_start).alias("start"), F.col("compared").alias("compared"))


def _word(words: str, place: Column) -> Column:
    """The word at a place counted from 0, NULL beyond either end."""
    return F.get(F.col(words), place)


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", least_words: int = LEAST_WORDS
) -> DataFrame:
    """``docs`` without those that contain a benchmark item. Rows without doc_id are judged by their text alone.

    A row goes if any row of its doc_id does. Columns of any name stay as they are; see ``find_leaks`` for NULLs and empty tables.
    """
    named = F.coalesce(F.concat(F.lit("#"), F.col(doc_id).cast("string")), F.sha2(F.col(text), 256))
    source = docs.select(named.alias("name"), F.col(text).alias("text"))
    leaks = find_leaks(source, benchmark, "text", "name", least_words=least_words).select(F.col("doc_id").alias("leak")).distinct()
    boxed = docs.select(F.struct("*").alias("row"), named.alias("name"))
    return boxed.join(leaks, F.col("name") == F.col("leak"), "left_anti").select("row.*")
