"""Benchmark decontamination: short test items inside long documents (DataFrame functions only).

Words are lower-cased runs of letters and digits; each character of a script that is written without spaces (Han, Kana, Thai, Lao, Khmer,
Burmese) is a word. Grams are runs of five words, as 64-bit hashes; an item of fewer words has one gram, all of them. An item is
contained in a document when at least ``threshold`` of the item's distinct grams occur in it.

Search: items are partitioned by size (powers of two of their gram count). Each item is represented by a
bottom-k sketch: its grams that are in the fewest items, of equally frequent ones those with the smallest hashes (MinHash). A partition's
sketch size follows from its upper size u: an item of n <= u grams that is contained misses floor((1 - threshold) * n) of them at most, so
of any floor((1 - threshold) * u) + 1 of its grams at least one occurs in the document. The search thus loses nothing, however
long the document, and joins only a fraction of the items' grams against the corpus. What many items have in common (a lead-in) is not in their
sketches as long as they have enough of their own, so it makes no candidates.
Candidates are verified by exact containment of all the item's grams. Documents and items are told apart by their texts; ids only name them.

Defined results: null and empty texts, and texts without a letter or digit, match nothing; a row without an id is judged like others; rows of one item
id with different texts are items of their own; rows of one document id give a row for the best of them; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shingles, spare, words, written

SHINGLE_WORDS = 5
#: Scripts written without spaces, as a class of a regular expression.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"


def tokens(text: Column) -> Column:
    """Words of a text, characters of unspaced scripts singly. The replacement runs only where a text isn't plain ASCII."""
    apart = F.regexp_replace(text, f"([{UNSPACED}])", " $1 ")
    return words(F.when(F.octet_length(text) > F.length(text), apart).otherwise(text))


def digest(text: Column) -> Column:
    """128 bits that stand for a text in joins."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def item_sketches(items: DataFrame, threshold: float, text_col: str) -> DataFrame:
    """item (digest of its text), words (in a gram), grams (distinct hashes), n (their number), sketch (some of them)."""
    texts = items.select(digest(F.col(text_col)).alias("item"), tokens(F.col(text_col)).alias("w")).where("size(w) > 0").dropDuplicates(["item"])
    own = shingles(F.col("w"), SHINGLE_WORDS)
    for k in range(1, SHINGLE_WORDS):
        own = F.when(F.size("w") == k, shingles(F.col("w"), k)).otherwise(own)
    grams = written(texts.select("item", F.least(F.size("w"), F.lit(SHINGLE_WORDS)).alias("words"), F.explode(F.array_distinct(own)).alias("h")), "decontam-grams")
    common = grams.groupBy("h").agg(F.count(F.lit(1)).alias("items"))
    sets = grams.join(common, "h").groupBy("item", "words").agg(F.sort_array(F.collect_list(F.struct("items", "h"))).alias("ranked"))
    sets = sets.select("item", "words", F.col("ranked.h").alias("grams"), F.size("ranked").alias("n"))
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n"))))
    least = (F.floor((1 - threshold) * upper + 1e-9) + 1).cast("int")
    return sets.withColumn("sketch", F.slice("grams", F.lit(1), F.least(F.col("n"), least)))


def grams_of(w: Column, lengths: list[int]) -> Column:
    """Grams of a document's words, of the lengths that the items have."""
    return F.concat(*[shingles(w, k) for k in lengths]) if lengths else F.array().cast("array<bigint>")


def contained(texts: DataFrame, items: DataFrame, threshold: float, item_text_col: str) -> DataFrame:
    """doc, item (digests of texts), n_item_shingles, n_common: a row for each item's text contained in one of ``texts`` (doc, text; rows may repeat)."""
    known = written(item_sketches(items, threshold, item_text_col), "decontam-items")
    lengths = sorted(r[0] for r in known.select("words").distinct().collect())  # 1 to 5
    # The words are a column of their own, so that they are split once and not for each gram.
    probes = texts.select("doc", tokens(F.col("text")).alias("w")).select("doc", F.explode(grams_of(F.col("w"), lengths)).alias("h"))
    found = written(probes.join(known.select("item", F.explode("sketch").alias("h")), "h").select("doc", "item").distinct(), "decontam-candidates")
    suspects = texts.join(found.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"])
    of_doc = (suspects.select("doc", tokens(F.col("text")).alias("w"))
              .select("doc", F.array_distinct(grams_of(F.col("w"), lengths)).alias("doc_grams")))
    wanted = found.join(known.select("item", "grams", "n"), "item")
    checked = of_doc.join(wanted, "doc").select(
        "doc", "item", F.col("n").cast("bigint").alias("n_item_shingles"),
        F.size(F.array_intersect("grams", "doc_grams")).cast("bigint").alias("n_common"))
    return checked.where(F.col("n_common") / F.col("n_item_shingles") >= threshold)


def find_contained(docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
                   item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_common, containment: a row for each item contained in a document."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null").withColumn("doc", digest(F.col("text")))
    hits = written(contained(texts, items, threshold, item_text_col), "decontam-hits")
    named = items.select(F.col(item_id_col).alias("item_id"), digest(F.col(item_text_col)).alias("item")).distinct()
    rows = texts.select("doc_id", "doc").join(hits, "doc").join(named, "item")
    best = rows.groupBy("doc_id", "item_id", "item", "n_item_shingles").agg(F.max("n_common").alias("n_common"))
    return best.drop("item").withColumn("containment", F.col("n_common") / F.col("n_item_shingles"))


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.8, text_col: str = "text", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text contains an item; all columns and other rows stay. Each row is judged by its own text."""
    mark = spare(docs, "text_hash")
    hashed = docs.withColumn(mark, digest(F.col(text_col)))
    texts = hashed.select(F.col(mark).alias("doc"), F.col(text_col).alias("text")).where("text is not null")
    bad = written(contained(texts, items, threshold, item_text_col).select(F.col("doc").alias(mark)).distinct(), "decontam-bad")
    return hashed.join(bad, mark, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
