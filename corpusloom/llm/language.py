"""Language identification by cross-parsing entropy.

For each language, a suffix automaton of a bounded sample of labelled text. A text is parsed greedily into the longest
phrases that occur in the sample; the language that needs the fewest phrases for the text's length wins. Every letter of the
samples is a symbol of its own, in whatever script; letters that no sample has share one. The automata are sparse
tables of transitions, so texts are parsed many stretches at a time: a text is cut into stretches of ``WIDTH`` symbols,
each parsed from the root, and its phrases are summed, which covers whole texts of any length in even work; a phrase that a
cut falls into counts as two, for every language alike.

Learned from ``PER_LANGUAGE`` labelled rows (lowest seeded hash of doc_id), up to ``SAMPLE`` symbols of each language; that
bound is the only one. Null or letterless texts (also empty ones) get ``und`` with score 0, as do all if nothing could be
learned; rows with a null lang teach nothing; repeated rows are judged one by one; extra columns pass through and those
named lang_pred and score are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import bounded_sample, crc_mod, free_names, table

PER_LANGUAGE, SAMPLE, WIDTH, UND = 48, 20_000, 2048, "und"
#: Texts are parsed in lots of about so many code points, which bounds a worker's memory.
LOT = 2_000_000


@dataclass
class Automaton:
    """A suffix automaton whose rows of transitions lie over each other in one table (row displacement).

    The last state stands before a text and after a symbol that the sample lacks: from it every symbol begins a phrase.
    """

    root: np.ndarray  #: by symbol, the state after a phrase's first symbol
    base: np.ndarray  #: by state, where its row begins
    slots: np.ndarray  #: at base + symbol, the state the slot belongs to (high half) and the next state (low half)


def automaton(symbols: list[int], alphabet: int) -> Automaton:
    nexts, links, lengths, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(nexts)
        nexts.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = links[p]
        if p >= 0:
            q = nexts[p][c]
            if lengths[p] + 1 == lengths[q]:
                links[cur] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                lengths.append(lengths[p] + 1)
                links.append(links[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = links[p]
                links[q] = links[cur] = copy
        last = cur
    root = np.array([nexts[0].get(c, len(nexts)) for c in range(alphabet)], np.int64)
    base = np.zeros(len(nexts) + 1, np.int64)
    # No phrase returns to the root, so its row is not filed. Half of the slots stay free, and wide rows come first.
    mask = (1 << (2 * sum(map(len, nexts[1:]))).bit_length()) - 1
    slots = np.full(mask + 1 + alphabet, -1, np.int64)
    used, at, tries = bytearray(len(slots)), 0, 0
    for state in sorted(range(1, len(nexts)), key=lambda s: -len(nexts[s])):
        row = nexts[state]
        while any(used[at + c] for c in row):
            at, tries = at + 1 & mask, tries + 1
            if tries > mask:
                slots, used = np.concatenate((slots, np.full(mask + 1, -1, np.int64))), used + bytes(mask + 1)
                mask, tries = 2 * mask + 1, 0
        base[state], tries = at, 0
        for c, to in row.items():
            used[at + c] = 1
            slots[at + c] = state << 32 | to
        at = at + 7919 & mask
    return Automaton(root, base, slots)


@dataclass
class Model:
    languages: list[str]
    symbol_of: np.ndarray  #: by code point; 0 is a gap between words
    tables: list[Automaton]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """By text and language the phrases needed, and by text the symbols other than gaps."""
        symbols, ends = _symbols(texts, self.symbol_of)
        starts = np.concatenate(([0], ends[:-1]))
        sizes = ends - starts
        letters = np.add.reduceat(np.concatenate((symbols > 0, [False])), starts) * (sizes > 0) if len(texts) else np.zeros(0)
        lanes = -(-sizes // WIDTH)
        owner = np.repeat(np.arange(len(texts)), lanes)
        first = np.repeat(starts, lanes) + (np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * WIDTH
        # Long stretches first: at each step those that go on are a prefix.
        left = np.minimum(ends[owner] - first, WIDTH)
        order = np.argsort(-left, kind="stable")
        owner, first, left = owner[order], first[order], left[order]
        going = len(left) - np.searchsorted(left[::-1], np.arange(WIDTH), "right")
        rows = [symbols[first[:n] + k] for k, n in enumerate(going.tolist()) if n]
        found = np.zeros((len(texts), len(self.languages)))
        for k, tab in enumerate(self.tables):
            state, broken = np.full(len(owner), len(tab.base) - 1), np.zeros(len(owner), np.int64)
            for row in rows:
                n = len(row)
                slot = tab.slots[tab.base[state[:n]] + row]
                new = slot >> 32 != state[:n]
                broken[:n] += new
                state[:n] = np.where(new, tab.root[row], slot & 0xFFFFFFFF)
            found[:, k] = np.bincount(owner, weights=broken, minlength=len(texts))
        return found, letters


def _symbols(texts: list[str], symbol_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' symbols in a row, gaps run together, and where each text ends."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "replace"), "<u4")
    raw = symbol_of[points]
    ends = np.cumsum([len(t) for t in low])
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] > 0) | (raw[:-1] > 0)
    return raw[keep], np.concatenate(([0], np.cumsum(keep)))[ends] if len(raw) else ends


def train(rows: list[tuple[str, str]], sample: int = SAMPLE) -> Model:
    """From (language, text) rows. The alphabet is the gap, one symbol for letters that the sample lacks, and every letter it has."""
    texts: dict[str, list[str]] = {}
    for lang, text in rows:
        texts.setdefault(lang, []).append(text)
    languages = sorted(texts)
    part = {lang: [t[: max(200, 2 * sample // len(texts[lang]))] for t in texts[lang]] for lang in languages}
    known = {c: i for i, c in enumerate(sorted({c for lang in languages for t in part[lang] for c in t.lower() if c.isalpha()}), 2)}
    symbol_of = np.array([known.get(chr(i), 1) if chr(i).isalpha() else 0 for i in range(0x110000)], np.int32)
    return Model(languages, symbol_of, [automaton(_symbols(["\n".join(part[lang])], symbol_of)[0][:sample].tolist(), len(known) + 2) for lang in languages])


def judge(model: Model, texts: list[str | None], sample: int = SAMPLE) -> tuple[list[str], list[float]]:
    """The language of each text and the weight it has among all, a phrase costing the bits of a place in the sample."""
    langs, scores = [UND] * len(texts), [0.0] * len(texts)
    if not model.languages:
        return langs, scores
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size < LOT):
            size += len(texts[j] or "")
            j += 1
        lot = [t or "" for t in texts[i:j]]
        found, letters = model.phrases(lot)
        for k, text in enumerate(lot):
            if letters[k] and any(c.isalpha() for c in text):
                cost = (found[k] - found[k].min()) * np.log(sample)
                best = int(found[k].argmin())
                langs[i + k], scores[i + k] = model.languages[best], float(1 / np.exp(-np.minimum(cost, 700)).sum())
        i = j
    return langs, scores


def learn(docs: DataFrame, where, per_language: int = PER_LANGUAGE) -> Model:
    """Fits on the rows ``where`` holds for, a bounded number of each language; their ids are drawn from narrow columns."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & where)
    drawn = bounded_sample(labelled.select("doc_id", "lang"), ["lang"], per_language, "doc_id", ["doc_id"]).distinct()
    rows = labelled.select("doc_id", "lang", "text").join(F.broadcast(drawn), "doc_id", "left_semi").select("lang", F.substring("text", 1, 2 * SAMPLE).alias("text"), "doc_id")
    return train([(r["lang"], r["text"]) for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["doc_id"], r["text"]))])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred and score; the model goes to the executors as one broadcast variable of bounded size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(texts: pa.Array) -> pa.Array:
        langs, scores = judge(shared.value, texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    verdict = F.arrow_udf(of, "struct<lang_pred:string,score:double>")(F.col("text"))
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    (name,) = free_names(docs, "verdict")
    return docs.select(*keep, verdict.alias(name)).select(*keep, f"{name}.lang_pred", f"{name}.score")


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = learn(docs, ~held_out & F.col("doc_id").isNotNull())
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
