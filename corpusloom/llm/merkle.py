"""Document fingerprints as Merkle trees over sections, paragraphs and leaves of a few words, in DataFrame functions alone.

A text is cut without loss: sections end after a blank line, paragraphs after a line break, leaves after ``LEAF_WORDS`` words. A
leaf's digest is the XXH64 of its characters; a paragraph's is that of its leaves' digests, a section's of its paragraphs',
and the root is a SHA-256 (first 32 hex digits) of the sections'. Equal texts have equal roots; where two roots differ, only
branches whose digests differ have to be looked into, which ``edits`` returns. The fingerprint string is the root, then the leaves'
digests (8 hex digits each), "." between paragraphs and "/" between sections. Likeness is the Dice share of distinct leaves:
1 for equal trees, 0 for trees without a common leaf, 1 for two empty texts.

``with_next`` gives every document the start of the next one by ascending doc_id. Only ids, lengths and hashes are ranked,
in ranges of doc_id; texts move once by doc_id, and of the next text only the part needed and its leaves' digests move again.

A null text counts as empty. Repeated rows keep a row each; rows of one doc_id count as one document in the order, whose text is the one of
least hash, and its successor is that of the next greater id. A null doc_id has no place in the order: nothing replaces what is cut off its text and its
near_next is that to an empty text. After the last id comes the first; a single document follows itself. An empty table gives an
empty result; extra columns pass through ``with_tree`` and are not read by the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import stash, table

LEAF_WORDS = 5
_SECTION = r"(?s).+?(?:\n[ \t]*\n\s*|\z)"
_PARAGRAPH = r"[^\n]*\n+|[^\n]+"


def tree(text: Column, leaf_words: int = LEAF_WORDS) -> Column:
    """Sections as arrays of paragraphs as arrays of leaf digests."""
    leaf = rf"(?:\S+\s*){{1,{leaf_words}}}|\s+"
    parts = lambda s, rule: F.regexp_extract_all(s, F.lit(rule), F.lit(0))
    return F.transform(parts(text, _SECTION), lambda s: F.transform(parts(s, _PARAGRAPH), lambda p: F.transform(parts(p, leaf), lambda x: F.xxhash64(x))))


def digests(built: Column) -> Column:
    """Of each section its paragraphs' digests."""
    return F.transform(built, lambda s: F.transform(s, lambda p: F.xxhash64(p)))


def fingerprint(built: Column) -> Column:
    root = F.substring(F.sha2(F.array_join(F.transform(digests(built), lambda s: F.hex(F.xxhash64(s))), "/"), 256), 1, 32)
    short = lambda d: F.substring(F.lpad(F.hex(d), 16, "0"), 9, 8)
    body = F.array_join(F.transform(built, lambda s: F.array_join(F.transform(s, lambda p: F.array_join(F.transform(p, short), "")), ".")), "/")
    return F.concat(root, F.lit(":"), F.lower(body))


def leaves(built: Column) -> Column:
    """The distinct leaves by the 32 bits of their digests that the fingerprint shows."""
    return F.array_distinct(F.transform(F.flatten(F.flatten(built)), lambda x: F.shiftright(F.shiftleft(x, 32), 32).cast("int")))


def likeness(a: Column, b: Column) -> Column:
    """Of two arrays of distinct leaves."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) * 2.0 / total)


def edits(a: Column, b: Column) -> Column:
    """The (section, paragraph) places of tree ``a``, from 0, whose paragraph isn't at that place in ``b``; sections whose digests agree aren't entered."""
    def paragraphs(s: Column, i: Column) -> Column:
        other = F.get(b, i)
        differ = F.transform(s, lambda p, j: F.when(~F.xxhash64(p).eqNullSafe(F.xxhash64(F.get(other, j))) | F.get(other, j).isNull(), F.struct(i.alias("section"), j.alias("paragraph"))))
        return F.when(s.eqNullSafe(other), F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(F.filter(differ, lambda x: x.isNotNull()))

    return F.flatten(F.transform(a, paragraphs))


def with_tree(docs: DataFrame, leaf_words: int = LEAF_WORDS) -> DataFrame:
    """Adds ``tree`` and ``fingerprint``."""
    return docs.withColumn("tree", tree(F.coalesce("text", F.lit("")), leaf_words)).withColumn("fingerprint", fingerprint(F.col("tree")))


def successors(docs: DataFrame) -> DataFrame:
    """(donor, donor_hash, recipient, need): for every doc_id the next one and a quarter of its own length. Of doc_id and text only narrow values are ranked."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    ids = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.xxhash64(text)).alias("hash"), F.max(F.floor(F.length(text) / 4)).alias("need"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = stash(ids.repartitionByRange(ranges, "doc_id").withColumn("range", F.spark_partition_id()))
    # A range's last id is followed by the first of the next range that has ids; there is one row a range.
    by_range = Window.partitionBy(F.lit(0)).orderBy("range")
    heads = ranked.groupBy("range").agg(F.min(F.struct("doc_id", "hash")).alias("head"))
    heads = heads.select("range", F.coalesce(F.lead("head").over(by_range), F.first("head").over(by_range)).alias("after"))
    following = F.lead(F.struct("doc_id", "hash")).over(Window.partitionBy("range").orderBy("doc_id"))
    joined = ranked.withColumn("next", following).join(F.broadcast(heads), "range")
    joined = joined.withColumn("next", F.coalesce("next", "after"))
    return joined.select(F.col("next.doc_id").alias("donor"), F.col("next.hash").alias("donor_hash"), F.col("doc_id").alias("recipient"), "need")


def with_next(docs: DataFrame, leaf_words: int = LEAF_WORDS) -> DataFrame:
    """(doc_id, text, start, next_leaves): each document with the first quarter of its own length of the next text, and that text's leaves.

    Both joins are by doc_id over the same repartitioned texts, so these are shuffled once and reused.
    """
    all_texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = all_texts.where("doc_id is not null").repartition("doc_id")
    # Written so that the hash is no second join key, by which the texts would have to be dealt anew.
    same_text = F.xxhash64("text").bitwiseXOR(F.col("donor_hash")) == 0
    given = own.join(successors(docs).hint("merge"), (F.col("doc_id") == F.col("donor")) & same_text)
    given = given.select(F.col("recipient").alias("to"), F.expr("left(text, cast(need as int))").alias("start"), leaves(tree(F.col("text"), leaf_words)).alias("next_leaves"))
    given = given.groupBy("to").agg(F.first("start").alias("start"), F.first("next_leaves").alias("next_leaves"))
    nothing = F.array().cast("array<int>")
    placed = own.join(given.hint("merge"), F.col("doc_id") == F.col("to"), "left").select("doc_id", "text", F.coalesce("start", F.lit("")).alias("start"), F.coalesce("next_leaves", nothing).alias("next_leaves"))
    return placed.union(all_texts.where("doc_id is null").select("doc_id", "text", F.lit(""), nothing))


def op3_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Beside the likenesses, what the trees locate of the edit: how many paragraphs differ, and the first one as section.paragraph (empty if none)."""
    paired = with_next(table(spark, sf_dir, "documents")).withColumn("n_chars", F.length("text"))
    edited = paired.withColumn("edited", F.expr("concat(left(text, n_chars - n_chars div 4), left(start, cast(n_chars div 4 as int)))".replace("n_chars - n_chars div 4", "cast(n_chars - n_chars div 4 as int)")))
    trees = edited.withColumn("tree", tree(F.col("text"))).withColumn("edited_tree", tree(F.col("edited")))
    found = trees.withColumn("leaves", leaves(F.col("tree"))).withColumn("places", edits(F.col("tree"), F.col("edited_tree")))
    return found.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("tree")).alias("fingerprint"),
        fingerprint(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(F.col("leaves"), leaves(F.col("edited_tree"))).alias("near_edited"),
        likeness(F.col("leaves"), F.col("next_leaves")).alias("near_next"),
        F.size("places").alias("edited_places"),
        F.concat_ws(".", F.get("places", F.lit(0))["section"], F.get("places", F.lit(0))["paragraph"]).alias("first_edit"),
    )
