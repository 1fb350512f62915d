"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding lowers letters and maps homoglyphs and digit substitutions to the letters they stand for; signs such as @ and $ stand for letters only
where a letter or digit follows. Accents stay, as they tell words apart, and a text with accents is matched a second time without them.
A folded text is its words between single spaces, so that a pattern tells by its own spaces whether it is a word or a word's beginning (a stem,
which inflected and compound forms share). The longest pattern at a word counts, unless the word stands in an exception
phrase. The sum of the weights found is normalised by length, ``sum * evenness / (words + evenness)``, and goes through a logistic curve.

Learned from a bounded sample of labelled rows (``PER_CLASS`` of each class, lowest seeded hash of doc_id), of which whole texts
teach, read on the executors: a term's weight is its log odds in toxic texts. A term needs ``LEAST_TEXTS`` such texts, odds of
e^``LEAST_ODDS`` and a signed root of the likelihood ratio of ``LEAST_ROOT``, none of which grows with the sample or asks for a share of the toxic
texts; at most ``TERMS`` are kept, the most significant ones, and of nested terms that stand in the same texts only the longest. Near copies would
count a text's words many times over, so a term's frequency counts texts of different least 5-word shingle. Phrases of a term and a
neighbour that the sample shows mainly in clean texts become exceptions, beside a fixed list. The evenness (one of ``EVENNESS``) is the likeliest on the sample.

Nulls: a null text counts as empty; labels that are null or without text teach nothing; with no labels every score is
the prior 0.27, below the cut. Repeated rows are scored one by one; an empty table stays empty; extra columns pass through and those
named score and predicted are replaced. Texts are scored whole, each in one task.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import bounded_sample, crc_mod, stash, table

PER_CLASS, TERMS, LEAST_ODDS, LEAST_ROOT, LEAST_TEXTS = 2000, 4000, 1.5, 4.0, 5
#: A stem has so many letters; longer beginnings add little to the longest, and whole words are terms too.
STEM = (3, 12)
EVENNESS = (10, 40, 160, 640, 2560, 10240)
#: Phrases in which a term of abuse is none.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "idiot proof", "loser bracket", "pond scum", "stupid simple")
#: Letters and digits that stand for Latin letters.
_LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "ɑ": "a", "ɡ": "g",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t",
}
#: Signs that do so before a letter or digit.
_SIGNS = str.maketrans({"@": "a", "$": "s", "!": "i"})
_SIGN = re.compile(r"[@$!]+(?=[^\W_])")
_WORD = re.compile(r"[^\W_]+")


def _tables() -> tuple[dict[int, str], dict[int, str]]:
    """One code point to one: lower case with lookalikes replaced, and letters without accents."""
    lower, bare = {}, {}
    for i in [*range(0x250), *range(0x370, 0x530), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        c = unicodedata.normalize("NFKC", chr(i)).lower()
        if len(c) != 1 or ord(c) in _SIGNS:
            continue
        c = _LOOKALIKES.get(c, c)
        if c != chr(i):
            lower[i] = c
        base = unicodedata.normalize("NFD", c)[0]
        if base != c and base.isalpha():
            bare[ord(c)] = base
    return lower, bare


_LOWER, _BARE = _tables()


def fold(text: str) -> str:
    return _SIGN.sub(lambda m: m[0].translate(_SIGNS), unicodedata.normalize("NFC", text)).translate(_LOWER)


def words_of(text: str) -> list[str]:
    return _WORD.findall(fold(text))


def patterns_of(words) -> set[str]:
    """Every stem and whole word, with and without accents."""
    found = set()
    for word in set(words):
        for w in {word, word.translate(_BARE)}:
            if len(w) >= STEM[0]:
                found.update(f" {w[:k]}" for k in range(STEM[0], min(STEM[1], len(w)) + 1))
                found.add(f" {w} ")
    return found


@dataclass
class Lexicon:
    """Weights by pattern: `` word `` or, without the space after it, the stem `` st``."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 1.0
    offset: float = -1.0
    evenness: float = 160.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, None))
        found.make_automaton()
        return found

    def hits(self, automaton, words: list[str]) -> dict[int, float]:
        """The weight of each word, by the place of the space before it, at which a pattern counts."""
        if not words or not len(automaton):
            return {}
        line = f" {' '.join(words)} "
        bare = line.translate(_BARE)
        longest: dict[int, tuple[int, float]] = {}
        excused: list[tuple[int, int]] = []
        for text in (line,) if bare == line else (line, bare):
            for end, (n, weight) in automaton.iter(text):
                start = end - n + 1
                if weight is None:
                    excused.append((start, end))
                elif start not in longest or longest[start][0] < n:
                    longest[start] = (n, weight)
        return {s: w for s, (_, w) in longest.items() if not any(a <= s < b for a, b in excused)}

    def total(self, automaton, text: str | None) -> tuple[float, int]:
        """The sum of the weights found and the number of words."""
        words = words_of(text or "")
        return sum(self.hits(automaton, words).values()), len(words)

    def feature(self, automaton, text: str | None) -> float:
        total, n = self.total(automaton, text)
        return total * self.evenness / (n + self.evenness)

    def score(self, feature: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * feature + self.offset, -60, 60))))


def fit_curve(features: list[float], labels: list[int]) -> tuple[float, float, float]:
    """Logistic regression on one feature by Newton steps with a slight ridge: slope, offset, log likelihood."""
    x, y = np.array(features), np.array(labels, float)
    if not len(y) or y.min() == y.max() or x.min() == x.max():
        return 1.0, -1.0, 0.0
    a, b = 0.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -60, 60)))
        g = np.array([((p - y) * x).sum() + 0.05 * a, (p - y).sum() + 0.01 * b])
        w = p * (1 - p)
        h = np.array([[(w * x * x).sum() + 0.05, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    z = a * x + b
    return float(a), float(b), float((y * z - np.logaddexp(0, z)).sum() - 0.025 * a * a)


def _terms(rows: DataFrame) -> dict[str, float]:
    """The lexicon's terms and weights."""
    def of(texts: pa.Array) -> pa.Array:
        import xxhash

        signs, found = [], []
        for t in texts:
            words = words_of(t.as_py())
            signs.append(min(xxhash.xxh64_intdigest(" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4))) - (1 << 63))
            found.append(sorted(patterns_of(words)))
        return pa.StructArray.from_arrays([pa.array(signs, pa.int64()), pa.array(found, pa.list_(pa.string()))], ["sign", "terms"])

    cut = stash(rows.select("toxic", F.arrow_udf(of, "struct<sign:long,terms:array<string>>")(F.col("text")).alias("cut")).select("toxic", "cut.*"))
    sizes = {r["toxic"]: r["n"] for r in cut.groupBy("toxic").agg(F.countDistinct("sign").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic:
        return {}
    by_text = cut.select("toxic", "sign", F.explode("terms").alias("term")).distinct()
    seen = by_text.groupBy("term").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).where(F.col("t") >= LEAST_TEXTS)
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("c") + 0.5) / (n_clean + 1))
    every, share = F.col("t") + F.col("c"), n_toxic / (n_toxic + n_clean)
    ratio = F.col("t") * F.log(F.col("t") / (every * share)) + (F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (every * (1 - share)))).otherwise(0.0) if n_clean else F.lit(0.0))
    best = seen.select("term", "t", "c", odds.alias("odds"), F.sqrt(F.greatest(2 * ratio, F.lit(0.0))).alias("root"))
    best = best.where((F.col("odds") >= LEAST_ODDS) & (F.col("root") >= LEAST_ROOT)).orderBy(F.desc("root"), F.desc(F.length("term")), "term").limit(TERMS)
    return longest_of({r["term"]: (r["t"], r["c"], r["odds"]) for r in best.collect()})


def longest_of(found: dict[str, tuple[int, int, float]]) -> dict[str, float]:
    """Without the terms that begin another one of the same counts: it stands in the same texts."""
    kept, ordered = {}, sorted(found)
    for i, term in enumerate(ordered):
        j = i + 1
        while j < len(ordered) and ordered[j].startswith(term) and found[ordered[j]][:2] != found[term][:2]:
            j += 1
        if j == len(ordered) or not ordered[j].startswith(term):
            kept[term] = found[term][2]
    return kept


def _benign(rows: DataFrame, weights: dict[str, float]) -> list[str]:
    """Pairs of a word with a term and a neighbour that stand mainly in clean texts."""
    lexicon = Lexicon(weights, ())

    def of(texts: pa.Array) -> pa.Array:
        automaton, found = lexicon.automaton(), []
        for t in texts:
            words = words_of(t.as_py())
            hits = lexicon.hits(automaton, words)
            starts = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words]))).tolist() if hits else []
            at = {bisect_right(starts, s) - 1 for s in hits}
            found.append(sorted({f"{words[i]} {words[i + 1]}" for k in at for i in (k - 1, k) if 0 <= i and i + 1 < len(words)}))
        return pa.array(found, pa.list_(pa.string()))

    pairs = rows.select("toxic", F.explode(F.arrow_udf(of, "array<string>")(F.col("text"))).alias("pair"))
    seen = pairs.groupBy("pair").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    return [r["pair"] for r in seen.where((F.col("c") >= LEAST_TEXTS) & (F.col("c") > 4 * F.col("t"))).orderBy(F.desc("c"), "pair").limit(TERMS).collect()]


def train(rows: DataFrame) -> Lexicon:
    """From the (toxic, text) rows of a bounded sample. Texts stay on the executors; terms, phrases and two numbers a row reach the driver."""
    weights = _terms(rows)
    learned = _benign(rows, weights) if weights else []
    lexicon = Lexicon(weights, (*EXCEPTIONS, *(p for p in learned if p not in EXCEPTIONS)))

    def of(texts: pa.Array) -> pa.Array:
        automaton = lexicon.automaton()
        found = [lexicon.total(automaton, t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([s for s, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64())], ["total", "n"])

    known = sorted(tuple(r) for r in rows.select(F.arrow_udf(of, "struct<total:double,n:long>")(F.col("text")).alias("f"), "toxic").select("f.*", "toxic").collect())
    labels = [y for _, _, y in known]
    curves = [(*fit_curve([s * k / (n + k) for s, n, _ in known], labels), float(k)) for k in EVENNESS]
    lexicon.slope, lexicon.offset, _, lexicon.evenness = max(curves, key=lambda c: (c[2], -c[3]))
    return lexicon


def learn(docs: DataFrame, labels: DataFrame, where, per_class: int = PER_CLASS) -> Lexicon:
    known = labels.where(F.col("toxic").isin(0, 1) & where).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    drawn = bounded_sample(known, ["toxic"], per_class, "doc_id", ["doc_id", "toxic"]).distinct()
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(drawn), "doc_id").select("toxic", "text")
    return train(stash(rows))


def rate(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Adds score and predicted."""
    def of(texts: pa.Array) -> pa.Array:
        automaton = lexicon.automaton()
        return pa.array([lexicon.score(lexicon.feature(automaton, t.as_py())) for t in texts], pa.float64())

    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    scored = docs.select(*keep, F.arrow_udf(of, "double")(F.col("text")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    lexicon = learn(docs, labels, ~held_out & F.col("doc_id").isNotNull())
    return rate(docs.select("doc_id", "text"), lexicon).select("doc_id", held_out.alias("held_out"), "score", "predicted")
