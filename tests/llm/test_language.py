import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import language

SOUNDS = {"en": "the tion ing and ou re er of".split(), "es": "ción que os la ado ñar el mente".split(), "de": "sch ung ich der und keit ä ver".split()}


def text(lang, n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 3))) for _ in range(n))


def corpus(n=90):
    langs = list(SOUNDS)
    return [(text(langs[i % 3], 5 + i % 40, i), langs[i % 3], "s") for i in range(n)]


def greedy(sample, symbols):
    """Phrases by looking for each longest stretch in the sample."""
    count, i = 0, 0
    s = "".join(map(chr, sample))
    t = "".join(map(chr, symbols))
    while i < len(t):
        n = 1
        while i + n < len(t) and t[i : i + n + 1] in s:
            n += 1
        count, i = count + 1, i + n
    return count


def test_parse_equals_plain_search():
    model = language.train([(lang, text(lang, 200, 7)) for lang in SOUNDS], sample=600)
    texts = [text("en", 60, 1), text("de", 300, 2).upper(), "123 !!", "x", "日本 語 the", "the" * 400, ""]
    found, letters = model.phrases(texts)
    sizes = []
    for i, t in enumerate(texts):
        symbols, _ = language._symbols([t], model.symbol_of)
        sizes.append(len(symbols))
        for k, lang in enumerate(model.languages):
            sample = language._symbols([text(lang, 200, 7)[:1200]], model.symbol_of)[0][:600].tolist()
            parts = [symbols[j : j + language.WIDTH].tolist() for j in range(0, len(symbols), language.WIDTH)]
            assert found[i, k] == sum(greedy(sample, p) for p in parts), (i, lang)
    assert letters.tolist() == [sum(c.isalpha() for c in t.lower()) for t in texts]


def test_query_holds_out(spark, docs, save):
    data = [*corpus(), (None, "en", "s"), ("", "en", "s"), ("123 ... \U0001f600", "de", "s"), (text("es", 9000, 5), None, "s"), ("\U00010400\U00010401", "en", "s")]
    found = {r["doc_id"]: r for r in language.op10_language(spark, save(documents=docs(*data).withColumn("score", F.lit("x")))).collect()}
    assert len(found) == len(data)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in found.items())
    own = [i for i in range(90) if found[i]["held_out"]]
    assert len(own) > 10 and sum(found[i]["lang_pred"] == data[i][1] for i in own) >= 0.95 * len(own)
    assert [found[90 + k]["lang_pred"] for k in range(4)] == ["und", "und", "und", "es"]
    assert found[92]["score"] == 0 and found[94]["lang_pred"] != "und"


def test_nothing_learned_and_no_rows(spark, docs, rows, save):
    found = language.op10_language(spark, save(documents=docs(("some words", None, "s")))).first()
    assert found["lang_pred"] == "und" and found["score"] == 0
    assert language.op10_language(spark, save(documents=docs("a").limit(0))).count() == 0


def test_score_is_a_share():
    model = language.train([(lang, text(lang, 100, 3)) for lang in SOUNDS])
    langs, scores = language.judge(model, [text("de", 30, 9), "x"])
    assert langs[0] == "de" and scores[0] > 0.99 and scores[1] == pytest.approx(1 / 3, abs=0.4) and not math.isnan(scores[1])


def test_many_scripts_at_once():
    """Languages that share a script, in several scripts with more letters together than any small alphabet holds."""
    scripts = {"latin": (97, 26), "cyrillic": (0x430, 32), "arabic": (0x621, 26), "hebrew": (0x5D0, 27), "greek": (0x3B1, 17), "thai": (0xE01, 46), "kana": (0x3042, 80), "hangul": (0xAC00, 900), "han": (0x4E00, 2500), "astral": (0x10428, 40)}
    sounds = {}
    for name, (start, n) in scripts.items():
        for k in range(2):
            rng = random.Random(f"{name}{k}")
            letters = [c for i in range(start, start + n) if (c := chr(i)).isalpha()]
            sounds[f"{name}{k}"] = ["".join(rng.choices(letters, k=3)) for _ in range(60)]
    make = lambda lang, n, seed: " ".join("".join(random.Random(f"{seed}/{i}").choices(sounds[lang], k=2)) for i in range(n))
    model = language.train([(lang, make(lang, 300, 1)) for lang in sounds])
    texts = [make(lang, 12, seed) for lang in sounds for seed in (2, 3, 4)]
    assert language.judge(model, texts)[0] == [lang for lang in sounds for _ in range(3)]
    assert len(set(language._symbols(["".join(map("".join, sounds.values()))], model.symbol_of)[0])) > 500
