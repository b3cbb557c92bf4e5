"""Spelling variants of a corpus's words: pairs one edit apart by asymmetric
q-chunks, and the frequent form of each word.

Of two words one edit apart, the shorter (or either, if equally long) gives
two disjoint chunks of half its length, the other its positional grams.  An
edit in or before the first half leaves the second chunk whole, any other the
first, at most one place further on, so such a pair shares a chunk.  The rest
of the words has the same edit in it and is cut in the same way once more:
a pair then shares two chunks, some three quarters of the word.  The join is
on these; what it finds is verified by the edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.runtime import checkpoint

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = "([A-Za-zÀ-ÿ]+)"


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2,
                noise: int | None = 31) -> DataFrame:
    """(word, n): the letter runs of all texts, A-Z in lower case, that have
    ``min_length`` code points and occur ``min_count`` times.

    With ``noise``, a run whose h = crc32 of ``<doc_id>:<run>`` it divides
    loses its code point h % length first (seeded misspellings).  A null id
    is the text ``null`` there; a null or empty text has no words; repeated
    rows count each time."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.col(text_col).alias("text"))
    runs = F.filter(F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(_RUN), F.lit(1)),
                    lambda w: F.char_length(w) >= min_length)
    word = rows.select("id", F.explode(runs).alias("word"))
    if noise:
        word = word.withColumn("h", F.crc32(F.concat_ws(":", "id", "word")))
        at = (F.col("h") % F.char_length("word")).cast("int")
        cut = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
        word = word.select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("word")).alias("word"))
        word = word.where(F.char_length("word") >= min_length)
    return word.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _part(text: Column, begin: Column, size: Column) -> Column:
    return F.substr(text, begin + 1, size)


def _keys(word: Column, size: Column, shift: int) -> Column:
    """Join keys of a word, as (case, first kept chunk, second kept chunk),
    for a chunk giver of ``size`` code points; ``shift`` is how much longer
    than the giver the word is (0 for the giver itself)."""
    half = F.floor(size / 2).cast("int")
    head = F.floor(half / 2).cast("int")  # first sub-chunk of the first half
    tail = half + F.floor((size - half) / 2).cast("int")  # where the last sub-chunk begins
    cases = (
        # (kept half: from, size), (kept sub-chunk of the other half: from, size)
        ((F.lit(0), half), (half, tail - half)),  # edit in the last quarter
        ((F.lit(0), half), (tail + shift, size - tail)),  # third quarter
        ((half + shift, size - half), (F.lit(0), head)),  # second quarter
        ((half + shift, size - half), (head + shift, half - head)),  # first quarter
    )
    return F.array(*[F.struct(F.lit(i).alias("case"), _part(word, *kept).alias("chunk"), _part(word, *sub).alias("sub"))
                     for i, (kept, sub) in enumerate(cases)])


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): words with exactly one code point inserted, deleted
    or replaced between them, each pair once.  ``words`` has (word, n) with
    different words; words of one code point get pairs too."""
    sized = words.select("word", "n", F.char_length("word").alias("size"))
    key = ["size", "case", "chunk", "sub"]
    givers = sized.select(F.col("word").alias("a"), F.col("n").alias("n_a"), "size",
                          F.inline(_keys(F.col("word"), F.col("size"), 0)))
    same = sized.select(F.col("word").alias("b"), F.col("n").alias("n_b"), "size",
                        F.inline(_keys(F.col("word"), F.col("size"), 0)))
    longer = (sized.where("size > 1").select(F.col("word").alias("b"), F.col("n").alias("n_b"), (F.col("size") - 1).alias("size"))
              .select("b", "n_b", "size", F.inline(_keys(F.col("b"), F.col("size"), 1))))
    found = givers.join(same.union(longer), key).where(
        ((F.char_length("b") > F.col("size")) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return found.select("a", "n_a", "b", "n_b").distinct()


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, n, form, form_n, n_near, root) of every word: its number of near
    words, the most frequent of them (of equals the smallest in code-point
    order) if that is ``ratio`` times as frequent, and the word at which
    following the forms ends.  Words without a form are their own root; an
    empty table gives no rows."""
    words = checkpoint(words)
    both = near_pairs(words).select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    common = F.col("near_n") >= ratio * F.col("n")
    formed = checkpoint(found.select("word", "n", "n_near", F.when(common, F.col("near")).alias("form"),
                                     F.when(common, F.col("near_n")).alias("form_n")))
    # a form is ``ratio`` times as frequent, so chains are short; doubling halves them each time
    steps = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        after = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = checkpoint(steps.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                    F.col("further").isNotNull().alias("moved")))
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return formed.join(steps.select("word", "root"), "word", "left").select(
        "word", "n", "form", "form_n", "n_near", F.coalesce("root", "word").alias("root"))
