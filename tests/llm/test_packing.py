import itertools
import zlib

import numpy as np
import pytest

from corpusloom.llm import packing

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(P.path(packing.VOCABULARY))
    found.encode_special_tokens = True
    return found


TEXTS = [
    None, "", "one", "Hello, World! don't we'll it's 'S", "naïve Straße ΣΊΣΥΦΟΣ İstanbul ﬁne é ́x", "日本語 x1y22 ½ ² a\x1cb\x85c d\x01e \x01", "<|endoftext|> <|StartOfText|>x </w> a</w>",
    "###*** %%% !!.,.;: (a)b[c] http://x.y/z?q=1 a_b", "word " * 9000, "👍🏽 emoji ok퟿", "x" * 5000, "a.\tb\x0bc\x0cd\r\ne",
]


def test_ids_equal_the_tokenizers(tokenizer):
    from corpusloom.llm.wordbpe import WordBpe

    for encoder in (WordBpe(P.path(packing.VOCABULARY)), WordBpe(P.path(packing.VOCABULARY), limit=3)):
        for _, text in itertools.product(range(2), TEXTS):
            assert np.frombuffer(encoder.encode(text or ""), "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_query_is_an_exact_cover(spark, docs, save, tokenizer):
    texts = [*TEXTS, *[" ".join(f"w{j % 97}" for j in range(i * 37 % 900)) for i in range(60)]]
    found = packing.op8_packing(spark, save(documents=docs(*texts))).collect()
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted((r for r in found if r["doc_id"] == i), key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids)
    windows = {}
    for r in found:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r["length"] for r in found)
    assert len(windows) <= -(-total // 4096) + 1


def test_repeated_and_no_rows(spark, docs, save):
    df = docs("some words")
    assert packing.op8_packing(spark, save(documents=df.union(df))).count() == 2
    assert packing.op8_packing(spark, save(documents=df.limit(0))).count() == 0


def plain(sizes, k):
    """Differencing one merge at a time, with lists."""
    parts = sorted(([s] + [0] * (k - 1) for s in sizes), reverse=True)
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1], reverse=True)
        a, b = parts.pop(0), parts.pop(0)
        parts.append(sorted((x + y for x, y in zip(a, reversed(b), strict=True)), reverse=True))
    return parts[0][0] - parts[0][-1]


def test_differencing_is_near_equal():
    rng = np.random.default_rng(3)
    for n, k in ((0, 3), (1, 3), (5, 5), (40, 3), (300, 7), (60, 50)):
        sizes = rng.integers(1, 500, n).tolist()
        where = packing.difference(sizes, k)
        sums = np.bincount(where, weights=sizes, minlength=k) if n else np.zeros(k)
        assert sums.sum() == sum(sizes) and (not n or sums.max() - sums.min() <= max(plain(sizes, k), 2) + 2)
    assert len(packing.difference([7, 7], 1)) == 2


def test_window_count_rises():
    assert sorted(packing.windows_for([6, 6, 6], 10)) == [0, 1, 2]
    assert max(packing.windows_for([5, 5, 5, 5], 10)) == 1
