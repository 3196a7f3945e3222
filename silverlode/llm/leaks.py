"""Benchmark decontamination as a prefix-filtered set join, DataFrame functions only.

A benchmark item is cut into windows of ``window`` words (a shorter item is one window),
a window into shingles of up to five words. A document can hold a window only if it holds
all of the window's shingles, so joining on one of them, the one that the fewest
documents' places carry, loses nothing. The position of that shingle in the window says
where the window would start (positional bound) and end (length bound); what passes is
compared word by word.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import copy_of, picked
from silverlode.session import stage

WINDOW = 10
SHINGLE = 5
#: What separates words once A-Z are lower case; words are all the rest (fixed value).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_az(text: Column) -> Column:
    """A-Z in lower case and nothing else; ASCII texts take the fast way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), BETWEEN), "")


def shingles(words: Column, n: int) -> Column:
    """Hash of every ``n`` consecutive words, at its place; empty where there are fewer."""
    places = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.slice(words, i, n)))


def item_windows(bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """(win, len, items): the distinct windows of (item_id, text) with the ids that hold them."""
    words = bench.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    cut = words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, length))).alias("win"))
    return cut.groupBy("win").agg(F.collect_set(F.col("item_id").cast("string")).alias("items")).withColumn("len", F.size("win"))


def hits(docs: DataFrame, bench: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, copy, n_hit, items) of the documents that hold a window, told apart by id and text hash."""
    d = picked(docs, doc_id=key, text=text).withColumn("copy", copy_of("text"))
    wins = stage(item_windows(picked(bench, item_id=item, text=item_text), window).withColumn("win_id", F.xxhash64("win")), "windows")
    lengths = sorted(r[0] for r in wins.select(F.least("len", F.lit(SHINGLE))).distinct().collect())  # five values at most
    if not lengths:
        lengths = [SHINGLE]

    # shingles of the windows, with their places
    own = [F.transform(shingles(F.col("win"), n), lambda h, i: F.struct(h.alias("h"), i.alias("at"))) for n in lengths]
    parts = wins.select("win_id", "win", "len", F.explode(F.coalesce(*[F.when(F.least("len", F.lit(SHINGLE)) == n, x) for n, x in zip(lengths, own, strict=True)])).alias("s")).select("win_id", "win", "len", "s.h", "s.at")

    # places of those shingles in the documents: the one pass over all words
    words = d.select("doc_id", "copy", words_of(F.col("text")).alias("words"))
    found = F.concat(*[F.transform(shingles(F.col("words"), n), lambda h, i: F.struct(h.alias("h"), i.alias("pos"))) for n in lengths])
    if len(lengths) == 1:
        placed = words.select("doc_id", "copy", F.posexplode(shingles(F.col("words"), lengths[0])).alias("pos", "h"))
    else:
        placed = words.select("doc_id", "copy", F.explode(found).alias("s")).select("doc_id", "copy", "s.pos", "s.h")
    # written, so that Spark knows its size before it plans the join: broadcast while small
    wanted = stage(parts.select("h").distinct(), "wanted")
    met = stage(placed.join(wanted, "h"), "met")

    # the rarest shingle of a window is its prefix; ties go to the smaller hash
    rarity = met.groupBy("h").agg(F.count("*").alias("n"))
    prefix = parts.join(rarity, "h").groupBy("win_id").agg(F.count_distinct("h").alias("seen"), F.min(F.struct("n", "h", "at")).alias("least"), F.any_value("win").alias("win"), F.any_value("len").alias("len"))
    whole = parts.groupBy("win_id").agg(F.count_distinct("h").alias("own"))
    prefix = prefix.join(whole, "win_id").where("seen = own").select("win_id", "len", F.col("least.h").alias("h"), F.col("least.at").alias("at"))
    spots = met.join(prefix, "h").select("doc_id", "copy", "win_id", (F.col("pos") - F.col("at")).alias("start")).where("start >= 0")

    # the words decide
    maybe = spots.join(wins.select("win_id", "win", "items"), "win_id").groupBy("doc_id", "copy").agg(F.collect_set(F.struct("start", "win", "items")).alias("maybe"))
    held = d.join(maybe.withColumnRenamed("doc_id", "id").withColumnRenamed("copy", "same"), F.expr("copy = same and doc_id <=> id")).dropDuplicates(["doc_id", "copy"])
    held = held.select("doc_id", "copy", "maybe", words_of(F.col("text")).alias("words"))
    sure = F.filter("maybe", lambda m: (m["start"] + F.size(m["win"]) <= F.size("words")) & (F.slice("words", m["start"] + 1, F.size(m["win"])) == m["win"]))
    # a filter here would be pushed below and cut the text anew for every candidate
    held = held.select("doc_id", "copy", sure.alias("sure"))
    n_hit = F.size(F.array_distinct(F.flatten(F.transform("sure", lambda m: F.sequence(m["start"], m["start"] + F.size(m["win"]) - 1)))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("sure", lambda m: m["items"]))))
    return stage(held.select(F.col("doc_id").alias("id"), "copy", n_hit.cast("long").alias("n_hit"), items.alias("items")), "hits").where("n_hit > 0")


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    NULL and wordless texts and items have no windows. NULL item ids count as no item
    id in ``n_items`` but their windows still hit. Repeated rows and repeated ids stay
    rows of their own: documents are told apart by id and text.
    """
    found = hits(docs, bench, window, key, text, item, item_text).withColumnRenamed("copy", "same")
    every = picked(docs, doc_id=key, text=text)
    every = every.select("doc_id", copy_of("text").alias("copy"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    out = every.join(found, F.expr("copy = same and doc_id <=> id"), "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
