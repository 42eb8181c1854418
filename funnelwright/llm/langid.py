"""Language of pages and documents: text likelihoods fused with declared language, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelwright.llm.common import Scratch

BUCKETS = 1 << 14  # of hashed character pairs
LEAST_PAIRS = 200  # character pairs of labelled text, whatever its share, for a language to be known
BELIEF = 200.0  # pairs' worth of belief in the mean of all languages, towards which those of few pairs are smoothed
OTHER = "other"  # the class of texts unlike all known languages; no code of a language has five letters
HELD_AT_ONCE = 64  # languages that a task sums before it passes sums on
SMOOTHING = 0.5
EVIDENCE = 60.0  # characters' worth of evidence that a text of any length may give at most
HOST_WEIGHT = 10.0  # pages' worth of belief in the level above
# Short codes that also are suffixes of addresses of a country: its language.
SUFFIX_LANGUAGE = {"at": "de", "ch": "de", "mx": "es", "ar": "es", "uk": "en", "us": "en", "be": "fr"}


def pairs(text: str) -> np.ndarray:
    """Hashed buckets of the pairs of neighbouring characters of a lower-cased text, at its ends a space."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    codes[(codes < 65) | ((codes > 90) & (codes < 97)) | ((codes > 122) & (codes < 128))] = 32
    both = (codes[:-1] << np.uint64(21)) | codes[1:]
    both = both[(codes[:-1] != 32) | (codes[1:] != 32)]
    return ((both * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)).astype(np.int64)


def _pair_counts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[str, np.ndarray] = {}
    for part in parts:
        for text, lang in zip(part["text"], part["lang"], strict=True):
            if lang not in total and len(total) == HELD_AT_ONCE:
                yield from _sums(total)
                total.clear()
            if lang not in total:
                total[lang] = np.zeros(BUCKETS, np.int64)
            total[lang] += np.bincount(pairs(text), minlength=BUCKETS)
    yield from _sums(total)


def _sums(total: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
    for lang, counts in total.items():
        held = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "bucket": held, "n": counts[held]})


class TextModel:
    """Log likelihoods of character pairs per language."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = languages, logs

    def evidence(self, text: str | None) -> np.ndarray:
        """Log likelihood of a text per language, tempered: the mean per pair times at most ``EVIDENCE`` pairs."""
        found = pairs(text) if text else np.empty(0, np.int64)
        if not len(found):
            return np.zeros(len(self.languages))
        score = self.logs[:, found].sum(axis=1, dtype=np.float64) * min(1.0, EVIDENCE / len(found))
        return np.round(score - score.max(), 9)  # so that the order of summation decides no tie


def background(shares: np.ndarray) -> np.ndarray:
    """Shares of character pairs in texts of no known language: half alike for all, half by the root of the known mean.

    Known pairs are likelier in their languages; pairs that these lack, or have rarely, are likelier here. All alike if none is known.
    """
    if not len(shares):
        return np.full(BUCKETS, 1 / BUCKETS)
    root = np.sqrt(shares.mean(axis=0))
    return 0.5 / BUCKETS + 0.5 * root / root.sum()


def train_text(labelled: DataFrame, text: str = "text", lang: str = "lang", least_pairs: int = LEAST_PAIRS) -> TextModel:
    """Counts of character pairs per language over all rows that have both a text and a language, and the class ``OTHER``.

    Every language with ``least_pairs`` character pairs is learnt, however small its share; texts of the others count as
    evidence of nothing. The fewer pairs, the more a language is taken to be like the mean of all, see ``BELIEF``. Without any
    language (an empty table, no labels, or all too short) there is the class ``OTHER`` alone.

    Tasks send sums, not texts; ``BUCKETS`` sums per language reach the driver (64 KB each).
    """
    rows = labelled.select(F.col(text).alias("text"), F.lower(F.trim(F.col(lang))).alias("lang"))
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL").filter(~F.col("lang").isin("", OTHER))
    sums = rows.mapInPandas(_pair_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = Scratch(labelled.sparkSession, "pair-counts").store(sums, "sums")
    sizes = sums.groupBy("lang").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_pairs)
    languages = sorted(row.lang for row in sizes.collect())
    place = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS))
    for row in sums.join(sizes.select("lang"), "lang").toLocalIterator():
        counts[place[row.lang], row.bucket] += row.n
    plain = counts + SMOOTHING
    if len(languages) > 1:
        mean = (plain / plain.sum(axis=1, keepdims=True)).mean(axis=0)
        plain = plain + BELIEF * mean
    shares = plain / plain.sum(axis=1, keepdims=True)
    return TextModel([*languages, OTHER], np.log(np.vstack([shares, background(shares)])).astype(np.float32))


def page_text(html: Column) -> Column:
    """The visible text of a page.

    What is not closed ends with the page (comments, scripts, styles) or before the next "<" (other marks), so that no part of
    the page is looked at for each mark before it.
    """
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|</?[a-z!?][^<>]*>?|&[#a-z0-9]+;", " ")


def markup_language(html: Column) -> Column:
    """The primary subtag of the lang attribute of the html element, or NULL."""
    return _code(F.regexp_extract(html, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1))


def address_host(url: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(url, r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit("")))


def address_suffix(url: Column) -> Column:
    """The language that an address names in its first folder, or else its top-level domain, or NULL."""
    folder = _code(F.regexp_extract(url, r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//[^/?#]+/([a-z]{2})(?:[-_][a-z]{2})?(?:[/?#]|$)", 1))
    country = _code(F.regexp_extract(address_host(url), r"\.([a-z]{2})$", 1))
    known = F.create_map(*[F.lit(x) for pair in SUFFIX_LANGUAGE.items() for x in pair])
    return F.coalesce(folder, F.try_element_at(known, country), country)


def site(host: Column) -> Column:
    """The last two labels of a host's name: the level between a host and the whole."""
    return F.coalesce(F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")), host)


def _code(column: Column) -> Column:
    return F.lower(F.nullif(column, F.lit("")))


def _scored(model: TextModel):
    @F.pandas_udf("array<double>")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: model.evidence(x).tolist())

    return score


def _vector(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def identify(
    docs: DataFrame, text: Column, model: TextModel, declared: Column | None = None, suffix: Column | None = None, host: Column | None = None
) -> DataFrame:
    """``docs`` with ``language``, ``confidence`` (its posterior), and ``text_language`` (by text alone).

    The posterior of a language is proportional to its prior on the row's host, times the tempered likelihood of the
    text, times the probabilities of the declared language and of the address suffix given the language. All but the
    text's likelihood come from grouped counts over all rows by the language that the text alone shows:

    * host prior: counts of the host, smoothed by ``HOST_WEIGHT`` rows of its site's prior, which is smoothed alike by
      the whole. Rows without host take the whole's.
    * declared and suffix: counts of each value per language, smoothed by ``SMOOTHING`` per cell, with a cell for values that no
      text with evidence has. A missing value says nothing.

    Texts are read twice, rather than written in between. Hosts, declared values and suffixes are joined with one row each, which
    Spark sends to all tasks while they are small; beyond that the join is by key, and adaptive execution splits values that hold many rows.

    Defined cases: NULL, empty or letterless text gives no evidence (text_language NULL); the rest decides. Ties go to
    the first language by name. Repeated rows count as often as they occur. Existing columns of these names are
    replaced. An empty table gives no rows.
    """
    n = len(model.languages)
    names = F.array(*[F.lit(x) for x in model.languages])
    nothing = F.lit(None).cast("string")
    marked = docs.drop("language", "confidence", "text_language").withColumns(
        {
            "_text": _scored(model)(text.cast("string")),
            "_declared": nothing if declared is None else declared,
            "_suffix": nothing if suffix is None else suffix,
            "_host": nothing if host is None else host,
        }
    )
    best = F.array_position("_text", F.array_max("_text")).cast("int")
    speaks = F.array_min("_text") < F.array_max("_text")
    marked = marked.withColumn("_guess", F.when(speaks, best))
    scratch = Scratch(docs.sparkSession, "language")
    counted = marked.filter("_guess IS NOT NULL").groupBy("_host", "_declared", "_suffix", "_guess").agg(F.count("*").alias("n"))
    counted = scratch.store(counted, "counts")

    total = np.full(n, 1.0)
    for row in counted.groupBy("_guess").agg(F.sum("n").alias("n")).collect():
        total[row["_guess"] - 1] += row["n"]
    share = total / total.sum()
    likely = {name: _conditional(counted, name, n, scratch) for name in ("_declared", "_suffix")}

    hosts = counted.filter("_host IS NOT NULL").withColumn("_site", site(F.col("_host")))
    sums = [F.sum(F.when(F.col("_guess") == i + 1, F.col("n")).otherwise(0)) for i in range(n)]
    by_host = hosts.groupBy("_host", "_site").agg(F.array(*sums).alias("own"))
    by_site = hosts.groupBy("_site").agg(F.array(*sums).alias("all"))
    smooth = lambda counts, above: F.zip_with(
        counts, above, lambda c, p: (c + HOST_WEIGHT * p) / (F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x) + HOST_WEIGHT)
    )
    priors = by_host.join(by_site, "_site").withColumn("above", smooth(F.col("all"), _vector(share)))
    priors = priors.select(F.col("_host").alias("_prior_of"), smooth(F.col("own"), F.col("above")).alias("_prior"))
    priors = scratch.store(priors, "priors")

    joined = marked.join(priors, F.col("_host") == F.col("_prior_of"), "left")
    logs = F.transform(F.coalesce("_prior", _vector(share)), lambda p: F.ln(p))
    for name, (table, unseen) in likely.items():
        joined = joined.join(table, F.col(name) == F.col(f"{name}_of"), "left")
        said = F.when(F.col(name).isNull(), _vector(np.zeros(n))).otherwise(F.coalesce(F.col(f"{name}_logs"), unseen))
        logs = F.zip_with(logs, said, lambda a, b: a + b)
    joined = joined.withColumn("_logs", F.zip_with(logs, "_text", lambda a, b: a + b))
    top = F.array_max("_logs")
    mass = F.aggregate(F.transform("_logs", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)
    done = joined.withColumns(
        {
            "language": F.element_at(names, F.array_position("_logs", top).cast("int")),
            "confidence": F.lit(1.0) / mass,
            "text_language": F.when(F.col("_guess").isNotNull(), F.element_at(names, F.coalesce("_guess", F.lit(1)))),
        }
    )
    joins = [f"{name}_{what}" for name in likely for what in ("of", "logs")]
    return done.drop("_text", "_declared", "_suffix", "_host", "_guess", "_prior_of", "_prior", "_logs", *joins)


def _conditional(counted: DataFrame, name: str, n: int, scratch: Scratch) -> tuple[DataFrame, Column]:
    """Log probability of each value of a column per language: a row per value, and a vector for values that have none."""
    sums = F.array(*[F.sum(F.when(F.col("_guess") == i + 1, F.col("n")).otherwise(0)) for i in range(n)])
    table = counted.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias(f"{name}_of")).agg(sums.alias("own"))
    table = scratch.store(table, f"values{name}")
    whole = table.agg(F.count(F.lit(1)).alias("cells"), *[F.sum(F.col("own")[i]).alias(f"n{i}") for i in range(n)]).first()
    cells = np.array([whole[f"n{i}"] or 0 for i in range(n)], float) + SMOOTHING * (whole["cells"] + 1)
    logs = F.zip_with("own", _vector(np.log(cells)), lambda count, all_of_it: F.ln(count + SMOOTHING) - all_of_it)
    return table.select(f"{name}_of", logs.alias(f"{name}_logs")), _vector(np.log(SMOOTHING / cells))


def page_languages(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """(page_id, host, declared, suffix, text_language, language, confidence) of each page (page_id, url, html).

    The text model is learnt from ``labelled`` (text, lang). Pages unlike all its languages are ``OTHER``.
    """
    html, url = F.col("html"), F.col("url")
    found = identify(pages, page_text(html), train_text(labelled), markup_language(html), address_suffix(url), address_host(url))
    return found.select(
        "page_id", address_host(url).alias("host"), markup_language(html).alias("declared"), address_suffix(url).alias("suffix"),
        "text_language", "language", "confidence",
    )


def keep_languages(
    docs: DataFrame, text: str = "text", declared: str = "lang", host: str = "source", wanted: list[str] | None = None, least: float = 0.5
) -> DataFrame:
    """The rows of ``docs`` whose language is one of ``wanted`` (all known ones) with a posterior of at least ``least``.

    Rows whose text has no evidence (NULL, empty, without letters) go, and those unlike all known languages (``OTHER``):
    they are in no language that is known. Where no language is known at all (see :func:`train_text`), nothing can be told of a
    text, and all with a letter stay, unless there are ``wanted`` languages. An empty table stays empty. Columns of any name stay
    as they are, repeated rows are judged alike.
    """
    model = train_text(docs, text, declared)
    if model.languages == [OTHER]:
        lettered = F.col(text).rlike(r"[A-Za-z]|[^\x00-\x7F]") & F.lit(wanted is None)
        return docs.filter(F.coalesce(lettered, F.lit(False)))
    boxed = docs.select(F.struct("*").alias("_row"))
    own = F.col("_row")
    found = identify(boxed, own[text], model, F.lower(F.trim(own[declared])), None, own[host])
    keep = F.col("text_language").isNotNull() & (F.col("language") != OTHER) & (F.col("confidence") >= least)
    if wanted is not None:
        keep &= F.col("language").isin(wanted)
    return found.filter(keep).select("_row.*")
