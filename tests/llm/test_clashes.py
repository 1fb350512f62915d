"""Extra columns of any name pass through the operators that say so, and leave their results alone."""

import inspect
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import common, htmltext, language, merkle, mixing, packing, secrets, simhash, toxicity

#: Every name that the operators' code gives to a column, whether or not it meets a user's.
NAMES = sorted({n.lower() for m in (common, htmltext, language, merkle, mixing, packing, secrets, simhash, toxicity) for n in re.findall(r"""["']([a-zA-Z_][a-zA-Z_0-9]{0,20})["']""", inspect.getsource(m))} - {"doc_id", "text", "lang", "source", "n_chars", "html", "page_id", "url"})
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon".split()
DOCS = [(i, " ".join(WORDS[i : i + 9]), "en", f"s{i % 2}") for i in range(8)] + [(9, "password=hunter22 " + " ".join(WORDS), "en", "s1")]

OPERATORS = {
    "language": (lambda d: language.identify(d, language.train([("en", "alpha beta gamma"), ("xx", "qqq www")])), {"lang_pred", "score"}),
    "toxicity": (lambda d: toxicity.rate(d, toxicity.Lexicon({" beta ": 1.0})), {"score", "predicted"}),
    "secrets": (secrets.scan, {"secrets"}),
    "mixing": (mixing.mix, {"size", "source_size", "target", "taken", "passes", "extra"}),
    "simhash": (simhash.dedup, set()),
    "merkle": (merkle.with_tree, {"tree", "fingerprint"}),
    "htmltext": (lambda d: htmltext.main_text(d.withColumn("html", F.col("text")), htmltext.Weights()), {"text", "n_chars"}),
}


def plain(rows, columns):
    return sorted(str([r[c] for c in columns]) for r in rows)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_extra_columns(docs, name):
    assert {"src", "shards", "seats", "_order", "row", "verdict", "_nth", "quota", "size"} <= set(NAMES)
    run, made = OPERATORS[name]
    bare = docs(*[(t, lang, s) for _, t, lang, s in DOCS])
    own = run(bare)
    extra = [n for n in NAMES if n not in {c.lower() for c in [*bare.columns, *made, "html"]}]
    wide = run(bare.select("*", *[F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in extra]))
    assert set(extra) <= set(wide.columns) and plain(own.collect(), own.columns) == plain(wide.select(*own.columns).collect(), own.columns)
    assert all(r[n] == f"{n}-{r['doc_id']}" for r in wide.select("doc_id", *extra).collect() for n in extra)


def test_packing_reads_no_other_columns(docs):
    import public_tokenizers

    path = public_tokenizers.path(packing.VOCABULARY)
    bare = docs(*[t for _, t, _, _ in DOCS])
    wide = bare.select("*", *[F.lit(1).alias(n) for n in NAMES])
    assert plain(packing.pack(bare, path).collect(), ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]) == plain(packing.pack(wide, path).collect(), ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"])
