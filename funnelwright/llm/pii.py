"""Personal data: patterns with checks, and a skip-chain conditional random field over all mentions of a document."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


KINDS = ("email", "ip", "card", "phone")  # label 0 is "none", label i + 1 is KINDS[i]
ROUNDS = 12
DAMPING = 0.3
SMOOTHING = 1.0

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# What may be personal data in another spelling: a run of digits with separators, and a word with "@" in it.
_NUMBER = re.compile(r"\+?\(?[0-9](?:[ ().-]{0,2}[0-9])+")
_AT = re.compile(r"@|\[at\]|\(at\)")
_SPELLED_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| dot |\[dot\])[A-Za-z0-9-]+)*")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _local_start(text: str, at: int, least: int) -> int:
    """Where the run of characters that an address's local part may have begins that ends at ``at``, not before ``least``."""
    while at > least and (text[at - 1] in "._%+-" or (text[at - 1].isascii() and text[at - 1].isalnum())):
        at -= 1
    return at


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each "@" outwards: a long run of letters without "@" is looked at once."""
    end = 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            start = _local_start(text, at, end)
            if start < at:
                end = domain.end()
                yield start, end
        at = text.find("@", max(at + 1, end))


def _spelled_addresses(text: str) -> Iterator[tuple[int, int]]:
    """Addresses in other spellings: "@" with a space on either side, and "[at]" or "(at)" with one on both or none.

    Leftmost matches, found from the sign outwards as above, so the time is linear in the text.
    """
    end = 0
    for sign in _AT.finditer(text):
        if sign.start() < end:
            continue
        local_end, domain_start = sign.span()
        before, after = text[local_end - 1 : local_end] == " ", text[domain_start : domain_start + 1] == " "
        if sign[0] != "@" and before != after:
            continue
        domain = _SPELLED_DOMAIN.match(text, domain_start + after)
        if domain:
            local_end -= before
            start = _local_start(text, local_end, end)
            if start < local_end:
                end = domain.end()
                yield start, end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind as listed, end) of the patterns' matches that pass their checks, sorted."""
    out = [(start, 0, end) for start, end in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, str, str]]:
    """(start, end, label or 0, shape, identity, whole) of the base spans and of what else may be personal data, in order.

    ``shape`` is what the spelling shows without the marks that the patterns ask for. ``identity`` is what repetitions
    share: the lower-cased address, or the last ten digits of a number. ``whole`` is the address, or all digits of the
    number without a "(0)", with its "+".
    """
    found = [(start, end, kind + 1) for start, kind, end in base]
    taken = sorted((start, end) for start, end, _ in found)
    if "@" in text or "at]" in text or "at)" in text:
        others = list(_spelled_addresses(text))
    else:
        others = []
    others += [m.span() for m in _NUMBER.finditer(text) if sum("0" <= c <= "9" for c in m.group()) >= 7]
    place = 0
    ends = []
    for start, end in sorted(others):
        while place < len(taken) and taken[place][0] < end:
            ends.append(taken[place][1])
            place += 1
        if not any(e > start for e in ends[-4:]):
            found.append((start, end, 0))
    out = []
    for start, end, label in sorted(found):
        own = text[start:end]
        if "@" in own or "at]" in own or "at)" in own:
            plain = re.sub(r"\s*(?:\[at\]|\(at\)|@)\s*", "@", own.lower())
            plain = re.sub(r" dot |\[dot\]", ".", plain)
            shape = f"@{min(3, plain.count('.'))}"
            whole = plain
        else:
            digits = "".join(c for c in own if "0" <= c <= "9")
            plain = digits[-10:]
            whole = re.sub("[^+0-9]", "", own.replace("(0)", "") if own.startswith("+") else own)
            shape = f"#{len(digits)}{'(' if '(' in own else ''}{'.' if '.' in own else ''}{'-' if '-' in own else ''}{' ' if ' ' in own else ''}"
        out.append((start, end, label, shape, plain, whole))
    return out


def skip_edges(identities: list[str]) -> list[tuple[int, int]]:
    """Each mention with the one before it of the same identity: a path through each group, so linear in its size."""
    last: dict[str, int] = {}
    out = []
    for i, name in enumerate(identities):
        if name in last:
            out.append((last[name], i))
        last[name] = i
    return out


def national(whole: str, label: int) -> list[str]:
    """What a number may also be known by: after a country code of one to three digits, or after a trunk 0 or a 00.

    Told by a leading sign: "+" for the number without its country code and "=" for the one with it, so that national
    spellings meet international ones only. Seven digits at least.
    """
    if whole.startswith("+"):
        return [f"={whole[1:]}", *(f"+{whole[n:]}" for n in (2, 3, 4))] if label and len(whole) >= 10 else []
    if whole.startswith("00"):
        return [f"={whole[2:]}"] if len(whole) >= 9 else []
    return [f"+{whole[1:]}"] if whole.startswith("0") and len(whole) >= 8 else []


def confirmed_fellows(found: list[tuple[int, int, int, str, str, str]]) -> list[dict[int, int]]:
    """Per mention that no pattern confirms: how many confirmed mentions of each label share its identity.

    Of mentions without such fellows, those whose number is the same but for trunk 0 and country code. Confirmed mentions
    are summed per identity once, so this is linear however often one is repeated.
    """
    exact: dict[str, dict[int, int]] = {}
    similar: dict[str, dict[int, int]] = {}
    for m in found:
        if m[2]:
            for table, keys in ((exact, [m[4]]), (similar, national(m[5], m[2]) if m[2] == len(KINDS) else [])):
                for key in keys:
                    own = table.setdefault(key, {})
                    own[m[2]] = own.get(m[2], 0) + 1
    out = []
    for m in found:
        fellows = {} if m[2] else exact.get(m[4], {})
        for key in national(m[5], 0) if not m[2] and not fellows else []:
            fellows = similar.get(key, fellows)
        out.append(fellows)
    return out


def propagate(unary: np.ndarray, edges: np.ndarray, pair: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals by loopy sum-product. ``unary`` (nodes, labels) and ``pair`` (edges, labels, labels) are logarithms.

    Exact on trees after as many rounds as the longest path has edges; ``rounds`` of damped messages otherwise.
    """
    n, k = unary.shape
    if not len(edges):
        belief = unary
    else:
        src = np.concatenate([edges[:, 0], edges[:, 1]])
        dst = np.concatenate([edges[:, 1], edges[:, 0]])
        weights = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.zeros((len(src), k))
        for _ in range(rounds):
            belief = unary.copy()
            np.add.at(belief, dst, message)
            out = belief[src] - message[back]
            joint = out[:, :, None] + weights
            top = joint.max(axis=1, keepdims=True)
            new = np.log(np.exp(joint - top).sum(axis=1)) + top[:, 0, :]
            new -= new.max(axis=1, keepdims=True)
            message = DAMPING * message + (1 - DAMPING) * new
        belief = unary.copy()
        np.add.at(belief, dst, message)
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def _counts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: how often each shape has each label, how often labels follow each other, and meet over skip edges."""
    for part in parts:
        seen: dict[tuple[str, str, int, int], int] = {}
        for text in part["text"]:
            if not text:
                continue
            found = mentions(text, base_spans(text))
            # The label of a confirmed mention's repetition is not known to be "none": it is not counted.
            labels = [None if fellows else m[2] for m, fellows in zip(found, confirmed_fellows(found), strict=True)]
            for m, label in zip(found, labels, strict=True):
                if label is not None:
                    key = ("shape", m[3], label, 0)
                    seen[key] = seen.get(key, 0) + 1
            for one, other in zip(labels, labels[1:], strict=False):
                if one is not None and other is not None:
                    seen["next", "", one, other] = seen.get(("next", "", one, other), 0) + 1
            sure = [m for m in found if m[2]]
            for i, j in skip_edges([m[4] for m in sure]):
                one, other = sorted((sure[i][2], sure[j][2]))
                seen["skip", "", one, other] = seen.get(("skip", "", one, other), 0) + 1
        yield pd.DataFrame([(*k, v) for k, v in seen.items()], columns=["what", "shape", "one", "other", "n"])


class Weights:
    """Log potentials from corpus counts.

    * Of a spelling: the smoothed share of each label among mentions of this shape. A mention that no pattern
      confirms keeps odds of at least e to 1 for "none" by its spelling alone; so only its fellows can change it.
    * Of neighbours: half the smoothed log lift of two labels next to each other.
    * Of skip edges: the smoothed log odds that fellows agree, counted where patterns confirm both, from 2 to 4.
    """

    def __init__(self, rows: list[tuple[str, str, int, int, int]]):
        k = len(KINDS) + 1
        self.shapes: dict[str, np.ndarray] = {}
        follow = np.full((k, k), SMOOTHING)
        skip = np.full((k, k), SMOOTHING)
        for what, shape, one, other, n in rows:
            if what == "shape":
                self.shapes.setdefault(shape, np.full(k, SMOOTHING))[one] += n
            elif what == "next":
                follow[one, other] += n
            else:
                skip[one, other] += n
        lift = np.log(follow / follow.sum()) - np.log(follow.sum(1) / follow.sum())[:, None] - np.log(follow.sum(0) / follow.sum())
        self.follow = np.clip(lift / 2, -0.5, 0.5)
        agree = np.trace(skip[1:, 1:])
        clash = np.triu(skip[1:, 1:], 1).sum()
        self.skip = np.eye(k) * float(np.clip(np.log(agree / clash), 2.0, 4.0))

    def unary(self, label: int, shape: str) -> np.ndarray:
        counts = self.shapes.get(shape)
        out = np.log(counts / counts.sum()) if counts is not None else np.zeros(len(KINDS) + 1)
        out = np.maximum(out, out.max() - 3)
        if label:
            out = np.full(len(out), -12.0)
            out[label] = 0
        else:
            out[0] = max(out[0], out[1:].max() + 1)
        return out

    def added(self, found: list[tuple[int, int, int, str, str, str]]) -> list[tuple[int, int, int]]:
        """(start, kind, end) of mentions that only their fellows reveal.

        Each is linked with all confirmed mentions of its identity. As the labels of these are given, their messages are
        constants, one coupling each, that sum per identity and are added to what the spelling says; how many other
        mentions are unconfirmed changes nothing. Repetitions without a confirmed fellow are linked as a path. The field is that of
        all mentions, but a mention without a confirmed fellow is never told: neighbours and repetitions alone reveal nothing.
        """
        fellows = confirmed_fellows(found)
        open_ = [i for i, m in enumerate(found) if not m[2] and not fellows[i]]
        skips = [(open_[i], open_[j]) for i, j in skip_edges([found[i][4] for i in open_])]
        linked = [i for i, own in enumerate(fellows) if own]
        if not linked:
            return []
        marginals = self.marginals(found, fellows, skips)
        best = marginals.argmax(axis=1)
        return [(found[i][0], int(best[i]) - 1, found[i][1]) for i in linked if best[i] and marginals[i, best[i]] > 0.5]

    def marginals(self, found: list[tuple[int, int, int, str, str, str]], fellows: list[dict[int, int]], skips: list[tuple[int, int]]) -> np.ndarray:
        """The probability of each label of each mention."""
        unary = np.stack([self.unary(m[2], m[3]) for m in found])
        for i, own in enumerate(fellows):
            for label, n in own.items():
                unary[i, label] += n * self.skip[label, label]
        chain = [(i, i + 1) for i in range(len(found) - 1)]
        pair = np.concatenate([np.broadcast_to(self.follow, (len(chain), *self.follow.shape)), np.broadcast_to(self.skip, (len(skips), *self.skip.shape))])
        return propagate(unary, np.array(chain + skips), pair)


def _found(weights: Weights):
    def told(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            base_texts, all_texts, counts = [], [], []
            for text in part["text"]:
                base = base_spans(text) if text else []
                own = sorted(base + weights.added(mentions(text, base))) if base else base
                base_texts.append(told(base))
                all_texts.append(told(own))
                counts.append([sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))])
            out = pd.DataFrame({"doc_id": part["doc_id"], "base_spans": base_texts, "spans": all_texts})
            for k, name in enumerate(KINDS):
                out[f"n_{name}"] = [c[k] for c in counts]
            yield out

    return run


def train(docs: DataFrame, text: str = "text") -> Weights:
    """Potentials from counts over all documents. What reaches the driver is a row per shape and label: the shape's
    digits are cut at 40, so there are at most a few thousand."""
    counts = docs.select(F.col(text).alias("text")).mapInPandas(_counts, "what string, shape string, one int, other int, n long")
    # Runs of more than 40 digits share a shape.
    shape = F.regexp_replace("shape", r"^#(?:4[1-9]|[5-9][0-9]|[0-9]{3,})", "#40")
    rows = counts.groupBy("what", shape.alias("shape"), "one", "other").agg(F.sum("n").alias("n")).collect()
    return Weights([tuple(row) for row in rows])


def find_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", weights: Weights | None = None) -> DataFrame:
    """Personal data of each row of ``docs``: doc_id, base_spans, spans, and n_email, n_ip, n_card, n_phone of the base.

    Spans are "kind:start:end" in code points, end exclusive, by start and kind, joined by commas. Base spans are the
    leftmost matches of a pattern per kind that pass its check (parts of an address at most 255; 12 to 19 digits with a
    right check digit; 9 to 15 digits). ``spans`` adds mentions in other spellings that the random field gives a kind
    to, because a repetition elsewhere in the document is confirmed. A document's field has a node per mention, edges
    between neighbours, and a factor per identity that links all its confirmed mentions with all others, so it is linear
    in the text.

    Defined cases: NULL and empty texts have no spans (empty strings, zeros). Repeated rows are repeated; a NULL doc_id
    stays NULL. Extra columns are ignored.
    """
    weights = weights or train(docs, text)
    schema = "doc_id long, base_spans string, spans string, n_email long, n_ip long, n_card long, n_phone long"
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ids = source.filter("doc_id IS NOT NULL").mapInPandas(_found(weights), schema)
    nameless = source.filter("doc_id IS NULL").withColumn("doc_id", F.lit(0).cast("long")).mapInPandas(_found(weights), schema)
    return ids.union(nameless.withColumn("doc_id", F.lit(None).cast("long")))


def masked(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets. NULL text stays NULL."""
    weights = train(docs, text)

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: _masked(x, weights), na_action="ignore")

    return docs.withColumn(text, mask(F.col(text)))


def _masked(text: str, weights: Weights) -> str:
    base = base_spans(text)
    out, at = [], 0
    for start, kind, end in sorted(base + weights.added(mentions(text, base))):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
