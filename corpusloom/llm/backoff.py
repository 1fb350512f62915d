"""LM scoring with stupid backoff over the corpus's own n-gram counts.

A word's score after two others is count(trigram) / count(bigram) if the trigram's count reaches ``min_count``, else ``ALPHA`` times
that of the bigram, else of the unigram, whose count is over all words. A document's score is the sum of the logarithms.

Counts cover every document and are exact: no n-gram is known by a hash. They are taken in three rounds, one an order, each a count
table dealt by hash and joined back to the n-grams that asked:

1. Words go as they are. Those that occur twice or more get numbers (a partition's place times the partitions, plus the partition).
2. A bigram of two numbered words is the pair of their numbers, an integer. Any other bigram occurs once, so it isn't sent.
   Those that occur twice or more get numbers in turn.
3. A trigram whose two bigrams are both numbered is the pair of the first one's number and the last word's. Any other occurs once.

A pair's integer is scrambled by a bijection of its bits, which deals any corpus evenly into ranges and keeps integers apart. Where two numbers
don't fit into 64 bits, the first is split, and its upper part becomes part of the partition.

The documents are cut into blocks of about ``block_tokens`` words, stored once with words as numbers. In a round, a block sends its distinct n-grams,
sorted, to the count table's partitions, one compact row a block and partition; a partition holds about ``partition_ngrams`` of them,
adds their counts up and answers the blocks that asked. So a frequent n-gram is one entry a block wherever it stands. Sums are taken per document
where the block's words are. The rows are blocks x partitions, so both sizes grow with the root of the corpus, from a million words up to ``MOST``.

Nulls: a null or empty text has no words, a total of 0 and a null score; repeated rows are scored one by one and count as often; an
empty table gives an empty result; extra columns are not read. A very long document is a block of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD, stash_by, table

ALPHA, MIN_COUNT = 0.4, 2
#: Words of a block and n-grams of a partition: at least, per root of the corpus's words, and at most.
LEAST, PER_ROOT, MOST = 1_000_000, 30, 16_000_000
_BLOCK = "block long, docs array<long>, ends array<long>, low binary, high binary, vocab binary"
_ASKED = "part long, block long, n long, keys binary, counts binary"
_ANSWER = "block long, part long, n long, mask binary, ids binary, counts binary, most long"
_PLANES = ((0, "<u2"), (16, "u1"), (24, "u1"), (32, "<u2"), (48, "<u2"))
_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _scrambled(x: np.ndarray, bits: int) -> np.ndarray:
    """A bijection of the integers of ``bits`` bits: every low bit reaches every high one, by which integers are dealt."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    for odd in _ODD:
        x = (x * np.uint64(odd)) & mask
        x = x ^ (x >> half)
    return (x * np.uint64(_ODD[0])) & mask


class Pairs:
    """Pairs of numbers, below ``firsts`` and ``seconds``, as scrambled integers of at most ``width`` bits in groups; one group unless they don't fit."""

    def __init__(self, firsts: int, seconds: int, width: int = 64):
        self.seconds = max(1, seconds)
        self.firsts = max(1, min(firsts, (1 << width) // self.seconds))
        self.groups = max(1, -(-firsts // self.firsts))
        self.bits = max(2, (self.firsts * self.seconds - 1).bit_length())

    def of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        firsts = np.uint64(self.firsts)
        return a // firsts, _scrambled((a % firsts) * np.uint64(self.seconds) + b, self.bits)

    def part(self, group: int, values: np.ndarray, parts: int) -> list[int]:
        """Where each partition's values begin in a group's sorted ones."""
        bounds = np.array([(k << self.bits) // parts for k in range(1, parts)], np.uint64)
        return [0, *np.searchsorted(values, bounds).tolist(), len(values)]


def _blocks(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        serial = TaskContext.get().partitionId() << 32
        docs: list = []
        ends: list[int] = []
        numbers: list[np.ndarray] = []
        size = 0
        vocab: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            nonlocal serial, docs, ends, numbers, vocab, size
            words = list(vocab)
            place = np.empty(len(words), np.uint32)
            order = _by_hash(words)[0]
            place[order] = np.arange(len(words), dtype=np.uint32)
            ids = place[np.concatenate(numbers)] if words else np.zeros(0, np.uint32)
            planes = [zlib.compress(p.astype("<u2").tobytes(), 1) for p in (ids & 0xFFFF, ids >> 16)]
            row = [[serial], [docs], [ends], [planes[0]], [planes[1]], [zlib.compress(b"\n".join(words[k] for k in order), 1)]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], ["block", "docs", "ends", "low", "high", "vocab"])
            serial += 1
            docs, ends, numbers, vocab, size = [], [], [], {}, 0
            return out

        for batch in batches:
            texts = batch.column(1)
            for i, doc in enumerate(batch.column(0).to_pylist()):
                words = (texts[i].as_py() or "").encode("utf-8", "replace").split()
                if size and size + len(words) > block_tokens:
                    yield flush()
                numbers.append(np.array([vocab.setdefault(w, len(vocab)) for w in words], np.uint32))
                size += len(words)
                docs.append(doc)
                ends.append(size)
        if docs:
            yield flush()

    return run


def _by_hash(words: list[bytes]) -> tuple[list[int], np.ndarray]:
    """The order of distinct words by hash, those of one hash by themselves; and the hashes in that order."""
    import xxhash

    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    order = np.argsort(hashes, kind="stable")
    found = hashes[order]
    if (found[1:] == found[:-1]).any():
        order = np.array(sorted(range(len(words)), key=lambda k: (hashes[k], words[k])), np.int64)
    return order.tolist(), hashes[order]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}


def _ids(row: dict) -> np.ndarray:
    """A block's words as places in its vocabulary."""
    low, high = (np.frombuffer(zlib.decompress(row[n]), "<u2").astype(np.uint32) for n in ("low", "high"))
    return low | high << np.uint32(16)


def _places(row: dict, n: int) -> np.ndarray:
    """Each word's place in its document."""
    ends = np.array(row["ends"], np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    return np.arange(n) - np.repeat(starts, ends - starts)


def _packed(values: np.ndarray) -> bytes:
    """Sorted values by difference, as planes of bytes, each left out at the end if it is zero."""
    if not len(values):
        return b""
    gaps = np.diff(values)
    planes = [(gaps >> np.uint64(shift)).astype(kind) for shift, kind in _PLANES]
    while len(planes) > 1 and not planes[-1].any():
        planes.pop()
    return values[:1].astype("<u8").tobytes() + b"".join(p.tobytes() for p in planes)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    gaps, at = np.zeros(n - 1, np.uint64), 8
    for shift, kind in _PLANES:
        if at < len(raw):
            gaps |= np.frombuffer(raw, kind, n - 1, at).astype(np.uint64) << np.uint64(shift)
            at += (n - 1) * np.dtype(kind).itemsize
    return np.cumsum(np.concatenate((np.frombuffer(raw, "<u8", 1), gaps)), dtype=np.uint64)


def _bytes(counts: np.ndarray) -> bytes:
    """Counts as single bytes, those of 255 and more again in full at the end."""
    large = counts >= 255
    return np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype("<u8").tobytes()


def _counts(raw: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    large = np.flatnonzero(counts == 255)
    counts[large] = np.frombuffer(raw, "<u8", len(large), n)
    return counts


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)], [name for name, _ in fields])


def _ask_words(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)
        for batch in batches:
            for row in _rows(batch):
                ids = _ids(row)
                words = zlib.decompress(row["vocab"]).split(b"\n") if len(ids) else []
                counts = np.bincount(ids, minlength=len(words))
                cuts = [0, *np.searchsorted(_by_hash(words)[1], bounds).tolist(), len(words)]
                yield _batch([(p, row["block"], e - s, zlib.compress(b"\n".join(words[s:e]), 1), _bytes(counts[s:e])) for p, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)) if e > s], _ASKED)

    return run


def _answers(rows: pa.Table, sizes: list[int], group: np.ndarray, distinct: int) -> pa.Table:
    """For each row, which of its n-grams (by ``group``, the number of each in the partition's order) occur twice or more, with their numbers and counts."""
    own = np.concatenate([_counts(r.as_py(), n) for r, n in zip(rows["counts"], sizes, strict=True)])
    total = np.bincount(group, weights=own, minlength=distinct).astype(np.int64)
    number = np.cumsum(total >= 2) - 1
    masks, ids, counts, at = [], [], [], 0
    for n in sizes:
        part = group[at : at + n]
        again = part[total[part] >= 2]
        masks.append(np.packbits(total[part] >= 2).tobytes())
        # Numbers rise within a row, so their differences are small.
        ids.append(_bytes(np.diff(number[again], prepend=0)))
        counts.append(_bytes(total[again]))
        at += n
    most = int((total >= 2).sum())
    columns = [rows["block"], rows["part"], rows["n"], pa.array(masks, pa.binary()), pa.array(ids, pa.binary()), pa.array(counts, pa.binary()), pa.array([most] * len(sizes), pa.int64())]
    return pa.table(dict(zip([f.strip().split(" ")[0] for f in _ANSWER.split(",")], columns, strict=True)))


def _answer_words(key: tuple, rows: pa.Table) -> pa.Table:
    """One partition of the words' count table."""
    sizes, known = rows["n"].to_pylist(), {}
    lists = [[known.setdefault(w, len(known)) for w in zlib.decompress(r.as_py()).split(b"\n")] for r in rows["keys"]]
    place = np.empty(len(known), np.int64)
    place[_by_hash(list(known))[0]] = np.arange(len(known))
    return _answers(rows, sizes, place[np.concatenate([np.array(x, np.int64) for x in lists])], len(known))


def _answer_pairs(key: tuple, rows: pa.Table) -> pa.Table:
    """One partition of a count table of pairs."""
    sizes = rows["n"].to_pylist()
    every = np.concatenate([_unpacked(r.as_py(), n) for r, n in zip(rows["keys"], sizes, strict=True)])
    order = np.argsort(every, kind="stable")
    found = every[order]
    group = np.empty(len(every), np.int64)
    group[order] = np.cumsum(np.concatenate(([False], found[1:] != found[:-1])))
    return _answers(rows, sizes, group, int(group.max(initial=-1)) + 1)


def _told(answers: list[dict] | None, n: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers (``_NONE`` where there is none) and counts (1 there) of a block's ``n`` distinct n-grams, in the order they were sent."""
    numbers, counts, at = np.full(n, _NONE), np.ones(n, np.int64), 0
    for a in sorted(answers or [], key=lambda a: a["part"]):
        mask = np.flatnonzero(np.unpackbits(np.frombuffer(a["mask"], np.uint8), count=a["n"])) + at
        numbers[mask] = (np.cumsum(_counts(a["ids"], len(mask))) * parts + a["part"]).astype(np.uint64)
        counts[mask] = _counts(a["counts"], len(mask))
        at += a["n"]
    return numbers, counts


def _sent(pairs: Pairs, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs by place: their sorted distinct (group, integer), how often each occurs, and each place's number among these."""
    group, value = pairs.of(a, b)
    order = np.argsort(value) if pairs.groups == 1 else np.lexsort((value, group))
    group, value = group[order], value[order]
    new = np.concatenate(([True], (value[1:] != value[:-1]) | (group[1:] != group[:-1]))) if len(value) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    back = np.empty(len(value), np.int64)
    back[order] = np.cumsum(new) - 1
    return group[first], value[first], np.diff(np.append(first, len(value))), back


class Round:
    """What a round knows of one block: by word, its number and count, and those of the bigram that ends at it, as far as they are told."""

    def __init__(self, row: dict, parts: int, two: Pairs | None = None, three: Pairs | None = None):
        ids = _ids(row)
        n = len(ids)
        place = _places(row, n)
        numbers, counts = _told(row["answers1"], int(ids.max()) + 1 if n else 0, parts)
        word, self.c1 = numbers[ids], counts[ids]
        self.place, self.c2, self.c3, self.sent = place, np.ones(n, np.int64), np.ones(n, np.int64), None
        if two is None:
            return
        at = np.flatnonzero((place[1:] >= 1) & (word[:-1] != _NONE) & (word[1:] != _NONE)) + 1
        self.sent = _sent(two, word[at - 1], word[at])
        if three is None:
            return
        numbers, counts = _told(row["answers2"], len(self.sent[1]), parts * two.groups)
        pair = np.full(n, _NONE)
        pair[at], self.c2[at] = numbers[self.sent[3]], counts[self.sent[3]]
        at = np.flatnonzero((place[1:] >= 2) & (pair[:-1] != _NONE) & (pair[1:] != _NONE)) + 1
        self.sent = _sent(three, pair[at - 1], word[at])
        if "answers3" in row:
            self.c3[at] = _told(row["answers3"], len(self.sent[1]), parts)[1][self.sent[3]]


def _ask_pairs(parts: int, two: Pairs, three: Pairs | None = None):
    """``parts`` partitions a group."""
    pairs = three or two

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                group, value, counts, _ = Round(row, parts, two, three).sent
                out, ends = [], np.searchsorted(group, np.arange(pairs.groups + 1, dtype=np.uint64)).tolist()
                for g, (lo, hi) in enumerate(zip(ends, ends[1:], strict=False)):
                    cuts = [lo + c for c in pairs.part(g, value[lo:hi], parts)]
                    out += [(g * parts + p, row["block"], e - s, _packed(value[s:e]), _bytes(counts[s:e])) for p, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)) if e > s]
                yield _batch(out, _ASKED)

    return run


def _score(total: int, min_count: int, alpha: float, parts: int, two: Pairs, three: Pairs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                known = Round(row, parts, two, three)
                place, (c1, c2, c3) = known.place, (c.astype(float) for c in (known.c1, known.c2, known.c3))
                before1, before2 = np.concatenate(([1.0], c1[:-1]))[: len(c1)], np.concatenate(([1.0], c2[:-1]))[: len(c2)]
                logs = np.minimum(place, 2) * np.log(alpha) + np.log(c1 / total)
                logs = np.where((place >= 1) & (c2 >= min_count), np.where(place >= 2, 1.0, 0.0) * np.log(alpha) + np.log(c2 / before1), logs)
                logs = np.where((place >= 2) & (c3 >= min_count), np.log(c3 / before2), logs)
                ends = np.array(row["ends"], np.int64)
                sizes = np.diff(ends, prepend=0)
                score = np.bincount(np.repeat(np.arange(len(ends)), sizes), weights=logs, minlength=len(ends)).astype(float)
                yield pa.RecordBatch.from_arrays([pa.array(row["docs"], pa.int64()), pa.array(sizes, pa.int64()), pa.array(score, pa.float64())], ["doc_id", "n_tokens", "total_score"])

    return run


def score(docs: DataFrame, *, alpha: float = ALPHA, min_count: int = MIN_COUNT, block_tokens: int | None = None, partition_ngrams: int | None = None, width: int = 64) -> DataFrame:
    """doc_id, n_tokens and total_score (the sum of the words' log scores). ``width`` is how many bits an integer may have."""
    if min_count < 2:
        raise ValueError("counts of 1 are not told apart from absence")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # About six bytes a word; this sets the sizes of blocks and partitions, no result.
    size = min(MOST, max(LEAST, int(PER_ROOT * ((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 6) ** 0.5)))
    blocks = stash_by(texts.mapInArrow(_blocks(block_tokens or size), _BLOCK), "block")
    total = blocks.agg(F.coalesce(F.sum(F.element_at("ends", -1)), F.lit(0))).first()[0]
    parts = max(8, -(-total // (partition_ngrams or size)))

    def told(asked: DataFrame, answer, k: int, groups: int = 1) -> tuple[DataFrame, int]:
        """The answers of a round by block, which are as large as the block, and a bound of the numbers given."""
        answers = asked.groupBy("part").applyInArrow(answer, _ANSWER).groupBy("block")
        found = stash_by(answers.agg(F.collect_list(F.struct("part", "n", "mask", "ids", "counts")).alias(f"answers{k}"), F.max("most").alias("most")), "block")
        return found.drop("most"), (found.agg(F.max("most")).first()[0] or 0) * parts * groups

    def joined(*more: DataFrame) -> DataFrame:
        out = blocks
        for df in more:
            out = out.join(df, "block", "left")
        return out

    first, words = told(blocks.mapInArrow(_ask_words(parts), _ASKED), _answer_words, 1)
    two = Pairs(words, words, width)
    second, bigrams = told(joined(first).mapInArrow(_ask_pairs(parts, two), _ASKED), _answer_pairs, 2, two.groups)
    three = Pairs(bigrams, words, width)
    third, _ = told(joined(first, second).mapInArrow(_ask_pairs(parts, two, three), _ASKED), _answer_pairs, 3, three.groups)
    return joined(first, second, third).mapInArrow(_score(max(1, total), min_count, alpha, parts, two, three), "doc_id long, n_tokens long, total_score double")


def op6_backoff(spark, sf_dir: str) -> DataFrame:
    """``score`` is the mean of a word, which compares texts of any length; ``total_score`` the sum."""
    found = score(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_tokens", F.round("total_score", 4).alias("total_score"), F.when(F.col("n_tokens") > 0, F.round(F.col("total_score") / F.col("n_tokens"), 6)).alias("score"))


ORACLE = f"""
with docs as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as words from documents),
w as (select r, unnest(words) as w3, generate_subscripts(words, 1) as i from docs),
g as (select r, i, w3, lag(w3) over (partition by r order by i) as w2, lag(w3, 2) over (partition by r order by i) as w1 from w),
n as (select count(*)::double as n from w),
c1 as (select w3, count(*)::double as c from g group by all),
c2 as (select w2, w3, count(*)::double as c from g where i >= 2 group by all),
c3 as (select w1, w2, w3, count(*)::double as c from g where i >= 3 group by all),
s as (select g.r, case
    when t.c >= {MIN_COUNT} then ln(t.c / h2.c)
    when b.c >= {MIN_COUNT} then ln(b.c / h1.c) + case when i >= 3 then ln({ALPHA}::double) else 0 end
    else ln(u.c / n.n) + least(i - 1, 2) * ln({ALPHA}::double) end as l
  from g cross join n join c1 u on u.w3 = g.w3 left join c1 h1 on h1.w3 = g.w2
  left join c2 b on b.w2 = g.w2 and b.w3 = g.w3 left join c2 h2 on h2.w2 = g.w1 and h2.w3 = g.w2
  left join c3 t on t.w1 = g.w1 and t.w2 = g.w2 and t.w3 = g.w3),
sums as (select r, sum(l) as total from s group by r)
select doc_id, len(words)::bigint as n_tokens, round(coalesce(total, 0), 4) as total_score, case when len(words) > 0 then round(total / len(words), 6) end as score
from docs left join sums using (r)
"""
