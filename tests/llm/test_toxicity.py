import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import toxicity

BAD = ["florb", "grunk", "zarvo"]


def corpus(n=400):
    rng = random.Random(2)
    data, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices("abcdefg", k=4)) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        elif i % 7 == 0:
            words[:0] = ["garden", "grunk"]  # a benign phrase
        data.append(" ".join(words))
        labels.append(int(toxic))
    return data, labels


@pytest.fixture
def folder(docs, rows, save):
    data, labels = corpus()
    data += [None, "", "FL0RB you gгunk", "florbing is fine", data[0]]
    table = rows("doc_id long, quality int, toxic int", *[(i, 1, y) for i, y in enumerate(labels)], (400, 1, 1), (401, 0, None), (9999, 1, 1))
    return save(documents=docs(*data).withColumn("score", F.lit("x")), labels=table), data, labels


def test_query(spark, folder):
    path, data, labels = folder
    found = {r["doc_id"]: r for r in toxicity.op7_toxicity(spark, path).collect()}
    assert len(found) == len(data) and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    own = [i for i in range(400) if found[i]["held_out"]]
    assert len(own) > 40 and sum(found[i]["predicted"] == labels[i] for i in own) >= 0.97 * len(own)
    assert [found[400 + k]["predicted"] for k in range(4)] == [0, 0, 1, 0] and found[404]["score"] == found[0]["score"]


def test_only_training_rows_teach(spark, folder, docs, rows, save):
    path, data, labels = folder
    flipped = rows("doc_id long, quality int, toxic int", *[(i, 1, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, y in enumerate(labels)])
    other = toxicity.op7_toxicity(spark, save(documents=docs(*data), labels=flipped)).select("doc_id", "score").collect()
    before = labels, {r["doc_id"]: r["score"] for r in other}
    again = toxicity.op7_toxicity(spark, save(documents=docs(*data), labels=flipped.where("crc32(cast(doc_id as string)) % 5 <> 0"))).collect()
    assert before[1] == {r["doc_id"]: r["score"] for r in again}


def test_no_labels_and_no_rows(spark, docs, rows, save):
    none = rows("doc_id long, quality int, toxic int")
    found = toxicity.op7_toxicity(spark, save(documents=docs("some text"), labels=none)).first()
    assert found["predicted"] == 0 and 0 <= found["score"] <= 1
    assert toxicity.op7_toxicity(spark, save(documents=docs("a").limit(0), labels=none)).count() == 0


def test_folding():
    assert toxicity.fold("1D10T") == "idiot" and toxicity.fold("ІДіот")[0] == "i" and toxicity.fold("ＡＢ") == "ab"
    assert toxicity.words_of("sh!t $tupid a$$hole") == ["shit", "stupid", "asshole"]
    # Signs that end a word stand for nothing, and accents tell words apart.
    assert toxicity.words_of("hi! word$$$ Àé") == ["hi", "word", "àé"] and toxicity.words_of("e\u0301") == ["é"]


def test_exceptions_words_and_stems():
    lexicon = toxicity.Lexicon({" clown ": 5.0, " réf": 2.0, " réfo": 3.0}, ("clown fish",))
    auto = lexicon.automaton()
    of = lambda t: lexicon.feature(auto, t)
    assert of("a clown fish swims") == 0 and of("clowns clownish") == 0 and of("you CL0WN!") > 0 and of("clown fish clown") > 0
    assert of("clown") > of("clown " + "word " * 500)
    assert of("réforme") > of("réfuter") > 0 and of("reforme préface") == 0 and of("clówn") > 0
    assert toxicity.Lexicon({}, ()).feature(toxicity.Lexicon({}, ()).automaton(), "x") == 0


def plain_total(lexicon, words):
    """No automaton: each word against each term."""
    bare = lambda w: w.translate(toxicity._BARE)
    out = 0.0
    for i, word in enumerate(words):
        best = (0, 0.0)
        for term, weight in lexicon.weights.items():
            whole, stem = term.endswith(" "), term.strip()
            if any((w == stem if whole else w.startswith(stem)) for w in (word, bare(word))):
                best = max(best, (len(term), weight))
        for phrase in lexicon.exceptions:
            p = phrase.split()
            for s in range(max(0, i - len(p) + 1), i + 1):
                if p in ([*words[s : s + len(p)]], [bare(w) for w in words[s : s + len(p)]]):
                    best = (0, 0.0)
        out += best[1]
    return out


def test_matches_a_plain_matcher():
    rng = random.Random(9)
    make = lambda: "".join(rng.choices("aéoß", k=rng.randint(1, 5)))
    lexicon = toxicity.Lexicon({t: rng.randint(1, 9) * 1.0 for t in {f" {make()}{rng.choice(['', ' '])}" for _ in range(40)}}, tuple({f"{make()} {make()}" for _ in range(30)}))
    auto, seen = lexicon.automaton(), 0
    for _ in range(300):
        words = [make() for _ in range(rng.randint(0, 30))]
        found = lexicon.total(auto, " ".join(words))
        assert found == (plain_total(lexicon, words), len(words))
        seen += found[0] > 0
    assert seen > 100


def test_nested_terms():
    assert toxicity.longest_of({" tra": (9, 0, 1.0), " tras": (9, 0, 1.0), " tras ": (9, 0, 1.0), " trap": (5, 0, 2.0), " t": (12, 4, 0.5)}) == {" tras ": 1.0, " trap": 2.0, " t": 0.5}


def test_held_out_rows_by_language(spark):
    """On 10,000 documents: of held-out toxic rows at least nine of ten in each language (but for chance in the smallest), and almost no clean ones."""
    sf = "/root/testdata/sf0.1"
    found = toxicity.op7_toxicity(spark, sf).where("held_out")
    facts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    by = {(r["lang"], r["toxic"]): (r["n"], r["p"]) for r in found.join(facts, "doc_id").groupBy("lang", "toxic").agg(F.count("*").alias("n"), F.sum("predicted").alias("p")).collect()}
    for lang in ("de", "en", "es", "fr"):
        n, caught = by[lang, 1]
        assert caught >= 0.9 * n - 0.6, by
    false = sum(p for (_, y), (_, p) in by.items() if y == 0)
    caught = sum(p for (_, y), (_, p) in by.items() if y == 1)
    assert caught / (caught + false) >= 0.95, by


def test_rare_terms_and_long_texts_teach(spark, docs, rows, save):
    """80 terms, each in a fortieth of the toxic texts, all beyond the first 20,000 code points."""
    rng = random.Random(4)
    terms = ["".join(rng.choices("hijkl", k=6)) for _ in range(80)]
    data, labels = [], []
    for i in range(1600):
        words = ["".join(rng.choices("abcdefg", k=3)) for _ in range(30)]
        if i % 2:
            words += [terms[i // 2 % 80], terms[(i // 2 + 1) % 80]]
        # Some are long; of each class as many.
        data.append(("abc def " * 3000 if i // 2 % 2 else "") + " ".join(words))
        labels.append(i % 2)
    path = save(documents=docs(*data), labels=rows("doc_id long, quality int, toxic int", *[(i, 1, y) for i, y in enumerate(labels)]))
    found = {r["doc_id"]: r for r in toxicity.op7_toxicity(spark, path).collect()}
    own = [i for i in found if found[i]["held_out"]]
    assert len(own) > 200 and sum(found[i]["predicted"] == labels[i] for i in own) >= 0.99 * len(own)
