"""Grouping of spelling variants: words one edit apart, found by the rotations of a permuterm index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelwright.llm.common import Scratch

RUN = r"A-Za-zÀ-ÿ"  # the characters of a word
LEAST_LENGTH = 7
LEAST_COUNT = 2
DROP_EVERY = 31  # of the checksums, for one of which a character goes
RATIO = 10  # times as frequent as a word its form is, at least
END = "$"  # ends a word before it is rotated; no character of words
LONG_WORD = 64  # code points beyond which rotations are known by 122-bit prints instead of spelled out

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PRIME = (1 << 61) - 1
_BASES = (1_000_003, 998_244_353)  # of the two polynomial prints


def _words(docs: DataFrame, text: str, doc_id: str, least_length: int, drop_every: int) -> DataFrame:
    """A row per occurrence of a run of letters that can give a word: the word."""
    pattern = f"[{RUN}]{{{least_length},}}"
    runs = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    print_ = F.crc32(F.concat(F.coalesce("doc_id", F.lit("")), F.lit(":"), "run"))
    at = F.pmod(print_, F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return runs.select(F.when(print_ % drop_every == 0, shorter).otherwise(F.col("run")).alias("word"))


def count_words(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    drop_every: int = DROP_EVERY,
) -> DataFrame:
    """(word, n): the words of whole texts and how often they occur.

    A word is a run of letters, A-Z lower-cased, of which the checksum of document and run may take a character. Words are
    counted in each task first, so frequent ones are a row per task in the shuffle.
    """
    words = _words(docs, text, doc_id, least_length, drop_every).filter(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _rotations(words: DataFrame) -> DataFrame:
    """The entries of the index: (key, skipped, single, id, n).

    A rotation of a word with its end mark begins after some character and ends with it. Without that last character it is the
    key under which all words that only differ in this character meet (``skipped``). A word that lacks the character has the
    whole key as a rotation, so it is entered under its whole rotations too. A character taken from a run of equal ones leaves
    the same word wherever in the run it was; only the first one counts for that (``single``).
    """
    length = F.char_length("word")
    entries = words.select("id", "n", "word", F.explode(F.sequence(F.lit(0), length)).alias("at"))
    head = F.substring("word", F.lit(1), F.col("at"))
    here = F.substring("word", F.col("at") + 1, F.lit(1))
    before = F.substring("word", F.greatest(F.col("at"), F.lit(1)), F.lit(1))
    first = (F.col("at") == 0) | (here != before)
    whole = F.struct(F.concat(F.substring("word", F.col("at") + 1, length), F.lit(END), head).alias("key"), F.lit(False).alias("skipped"), F.lit(False).alias("single"))
    without = F.struct(F.concat(F.substring("word", F.col("at") + 2, length), F.lit(END), head).alias("key"), F.lit(True).alias("skipped"), first.alias("single"))
    both = F.when(F.col("at") < length, F.array(whole, without)).otherwise(F.array(whole))
    return entries.select("id", "n", F.explode(both).alias("entry")).select("entry.*", "id", "n")


def _printed(long_word: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The entries of long words. A print of a rotation follows from the prints of the word's prefixes in a few steps.

        Words of the limit's length are only entered whole, for the words that are longer; among each other they meet spelled out.
        """
        for batch in batches:
            for word, number, n in zip(batch["word"], batch["id"], batch["n"], strict=True):
                size, prints = len(word), [_Prints(word, base) for base in _BASES]

                def key(start: int, head: int, prints=prints, size=size) -> str:
                    return END.join(["", str(size - start + head), *(f"{own.around(start, head):x}" for own in prints)])

                for begin in range(0, size + 1, 10_000):
                    at = range(begin, min(begin + 10_000, size + 1))
                    rows = [(key(i, i), False, False) for i in at]
                    if size > long_word:
                        rows += [(key(i + 1, i), True, i == 0 or word[i] != word[i - 1]) for i in at if i < size]
                    part = pd.DataFrame(rows, columns=["key", "skipped", "single"])
                    yield part.assign(id=np.int64(number), n=np.int64(n))

    return run


class _Prints:
    """Polynomial prints of a word's prefixes, from which those of its rotations follow."""

    def __init__(self, word: str, base: int):
        self.base, self.size = base, len(word)
        self.power, self.prefix = [1], [0]
        for character in word:
            self.power.append(self.power[-1] * base % _PRIME)
            self.prefix.append((self.prefix[-1] * base + ord(character)) % _PRIME)

    def around(self, start: int, head: int) -> int:
        """Print of the characters from ``start``, the end mark, and the first ``head`` characters."""
        tail = self.prefix[self.size] - self.prefix[start] * self.power[self.size - start]
        return ((tail * self.base + ord(END)) * self.power[head] + self.prefix[head]) % _PRIME


def _neighbours(entries: DataFrame) -> DataFrame:
    """(id, n_near, best): per word the number of its near words, and the most frequent, the first in order among equals.

    Entries are sorted by key; the words of a key, at most one per character that can stand in the skipped place and the one
    without it, are near each other. Each only learns how many they are and which is the best but itself, so no pairs are made.
    """
    in_key = Window.partitionBy("key").orderBy(F.desc("skipped"), "less", "id")
    whole = in_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.struct("less", "id")
    scanned = entries.withColumn("less", -F.col("n")).select(
        "id", "skipped", "single",
        F.row_number().over(in_key).alias("place"),
        F.first(own).over(whole).alias("first"),
        F.lead(F.when(F.col("skipped"), own)).over(in_key).alias("second"),
        F.count_if("skipped").over(whole).alias("n_skipped"),
        F.count_if("single").over(whole).alias("n_single"),
        F.min(F.when(F.col("single"), own)).over(whole).alias("longer"),
        F.min(F.when(~F.col("skipped"), own)).over(whole).alias("shorter"),
    )
    replaced = F.when(F.col("place") > 1, F.col("first")).otherwise(F.col("second"))
    shorter = F.when(F.col("single"), F.col("shorter"))
    near = F.when(F.col("skipped"), F.col("n_skipped") - 1 + shorter.isNotNull().cast("long")).otherwise(F.col("n_single"))
    best = F.when(F.col("skipped"), F.least(replaced, shorter)).otherwise(F.col("longer"))
    found = scanned.select("id", near.alias("n_near"), best.alias("best")).filter("n_near > 0")
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root): where following forms from a word ends. A step makes a word ``RATIO`` times as frequent, so there are few."""
    roots, turn = forms.select("id", F.col("form").alias("root")), 0
    while True:
        roots = scratch.store(roots, f"roots-{turn}")
        onward = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
        if roots.join(onward, "root", "left_semi").isEmpty():
            return roots
        roots = roots.join(onward, "root", "left").select("id", F.coalesce("next", "root").alias("root"))
        turn += 1


def group_variants(words: DataFrame, ratio: int = RATIO, long_word: int = LONG_WORD) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of counted words, see :func:`spelling_variants`; words are distinct and not NULL."""
    scratch = Scratch(words.sparkSession, "spelling")
    # Sorted by word and numbered in that order: entries then carry a number that compares as the word does. The table is stored
    # at once, so that the numbers last.
    ordered = words.select("word", F.col("n").cast("long").alias("n")).orderBy("word").withColumn("id", F.monotonically_increasing_id())
    known = scratch.store(ordered, "words")
    short = F.char_length("word") <= long_word
    long_ones = known.filter(F.char_length("word") >= long_word)
    printed = long_ones.mapInPandas(_printed(long_word), "key string, skipped boolean, single boolean, id long, n long")
    near = scratch.store(_neighbours(_rotations(known.filter(short)).unionByName(printed)), "near")

    enough = F.col("best.less") * -1 >= ratio * F.col("n")
    judged = known.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.id")).alias("form_id"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    judged = scratch.store(judged, "judged")
    roots = _roots(judged.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")), scratch)
    spelled = known.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    ends = known.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    changed = judged.filter("form_id IS NOT NULL").join(roots.withColumnRenamed("root", "root_id"), "id").join(spelled, "form_id").join(ends, "root_id")
    kept = judged.filter("form_id IS NULL").select("word", "n", "n_near", F.lit(None).cast("string").alias("form"), "form_n", F.col("word").alias("root"))
    return kept.unionByName(changed.select("word", "n", "n_near", "form", "form_n", "root"))


def spelling_variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The words of all texts with the frequent word each is probably a variant of.

    Returns word; n, its occurrences; n_near, how many other words differ by exactly one inserted, deleted or replaced
    character; form, the most frequent of these if it is ``RATIO`` times as frequent (ties: the first in code-point order), and
    form_n, its occurrences; root, the word reached by following forms.

    Defined cases: NULL and empty texts, and texts without long runs of letters, give no words; neither do empty tables. A
    NULL doc_id counts as an empty one in the checksum. Repeated rows count as often as they are there. Words of any length are
    handled: beyond ``LONG_WORD`` rotations are compared by prints of 122 bits. Other columns are not looked at.
    """
    return group_variants(count_words(docs, text, doc_id))
