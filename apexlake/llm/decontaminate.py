"""Benchmark decontamination with a distributed positional inverted index.

The index stores, for a set of terms, every position of every document where
they occur. A phrase is looked up from its rarest terms: their lists are
shifted by the terms' offsets in the phrase, so that an occurrence of the whole
phrase shows up at one document and start, and intersected. What is left is
compared word by word. Only the lists of the terms that are looked up are
stored; how rare a term is, is counted over all documents.

All of it is DataFrame code. Rows go by a key of id and text, so that two texts
under one id stay apart and repeated rows get equal results. Null and wordless
texts have no words and hit nothing; items without words are in no text; an
empty table gives an empty result. Only id and text columns are read, so other
columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apexlake.llm.common import lower_ascii, row_key, small
from apexlake.session import write_once

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words before A-Z are lowered: enough to count them.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOOKED_UP = 2  # terms of a phrase whose lists are intersected
BUCKETS = 1 << 18


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"), F.col(text).alias("text"))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, n)``: occurrences over all documents of the given terms that occur at all."""
    found = docs.select(F.explode(words_of(F.col("text"))).alias("term"))
    return found.join(small(terms, "terms"), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def positional_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, key, position)``: every occurrence of the given terms, stored."""
    found = docs.select("key", F.posexplode(words_of(F.col("text"))).alias("position", "term"))
    return write_once(found.join(small(terms, "terms"), "term", "left_semi").select("term", "key", "position"), "postings")


def phrases(items: DataFrame, window: int) -> DataFrame:
    """``(item_id, words, start, length)``: each window of each item; a shorter item is one phrase."""
    words = items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    return words.select(
        "item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("start"),
        F.least(F.size("words"), F.lit(window)).alias("length"),
    )


def _rarest(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """Each phrase, and where its rarest terms stand in the item; none if a term occurs nowhere.

    A word goes to the phrases it is in, one row each, so neither an item nor all
    its phrases are ever one row.
    """
    words = items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    placed = words.select("item_id", last.alias("last"), F.posexplode("words").alias("at", "term")).join(counts, "term", "left")
    starts = F.sequence(F.greatest(F.col("at") - (window - 1), F.lit(0)), F.least("at", "last"))
    inside = F.sort_array(F.collect_list(F.struct("at", "n", "term")))
    each = placed.withColumn("start", F.explode(starts)).groupBy("item_id", "start").agg(inside.alias("inside"))
    ordered = F.sort_array(F.transform("inside", lambda t: F.struct(t["n"].alias("n"), t["at"].alias("at"), t["term"].alias("term"))))
    return each.where(~F.exists("inside", lambda t: t["n"].isNull())).select(
        "item_id", "start", F.size("inside").alias("length"),
        F.transform("inside", lambda t: t["term"]).alias("phrase"),
        F.transform(F.slice(ordered, 1, LOOKED_UP), lambda t: F.struct(t["at"].alias("at"), t["term"].alias("term"))).alias("lookups"),
    )


def exact_matches(docs: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """``(key, item_id, start, length, at)``: every place ``at`` of a document where a phrase of an item stands.

    ``docs`` has ``doc_id, key, text`` (see :func:`keyed`), ``items`` has ``item_id, text``.
    """
    terms = items.select(F.explode(words_of(F.col("text"))).alias("term")).distinct()
    wanted = write_once(_rarest(items, term_counts(docs, terms), window), "phrases")
    lookups = wanted.select("item_id", F.explode("lookups").alias("l")).select(
        "item_id", F.col("l.at").alias("offset"), F.col("l.term").alias("term")).distinct()
    postings = positional_index(docs, lookups.select("term").distinct())

    # The lists, shifted: the place in the document where the item's first word would stand.
    shifted = postings.join(small(lookups, "lookups"), "term").select(
        "key", "item_id", (F.col("position") - F.col("offset")).alias("origin"), "offset")
    met = shifted.groupBy("key", "item_id", "origin").agg(F.collect_set("offset").alias("offsets"))
    # A phrase is looked for only where its rarest term stands at its place.
    by_rarest = wanted.withColumn("rarest", F.col("lookups")[0]["at"])
    candidates = met.withColumn("rarest", F.explode("offsets")).join(small(by_rarest, "wanted"), ["item_id", "rarest"]).where(
        F.forall("lookups", lambda o: F.array_contains("offsets", o["at"])))
    candidates = write_once(candidates.select(
        "key", "item_id", "start", "length", (F.col("origin") + F.col("start")).alias("at"), "phrase").where("at >= 0"), "candidates")

    # Texts are read again only where something may match: first by bucket, a table of bounded size, then by key.
    bucket = F.pmod("key", F.lit(BUCKETS))
    buckets = F.broadcast(candidates.select(bucket.alias("bucket")).distinct())
    texts = docs.withColumn("bucket", bucket).join(buckets, "bucket", "left_semi")
    texts = texts.join(candidates.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    checked = texts.select("key", words_of(F.col("text")).alias("own")).join(candidates, "key")
    return checked.where(F.slice("own", F.col("at") + 1, F.col("length")) == F.col("phrase")).select(
        "key", "item_id", "start", "length", "at")


def near_matches(docs: DataFrame, items: DataFrame, within: int, least: int = 3) -> DataFrame:
    """``(key, item_id, first, last, n_terms)``: stretches of at most ``within`` words with ``least`` rare terms of an item.

    The proximity side of the index: order does not count. An item's ``least``
    rarest terms are looked up (all of them if it has fewer); a stretch begins
    and ends at one of them and holds them all. Items with a term that occurs
    nowhere among those looked up have none.
    """
    terms = items.select("item_id", F.explode(F.array_distinct(words_of(F.col("text")))).alias("term"))
    counted = terms.join(term_counts(docs, terms.select("term").distinct()), "term", "left")
    ranked = counted.withColumn("place", F.row_number().over(
        Window.partitionBy("item_id").orderBy(F.col("n").asc_nulls_last(), "term"))).where(F.col("place") <= least)
    wanted = ranked.withColumn("needed", F.count("*").over(Window.partitionBy("item_id")))
    postings = positional_index(docs, wanted.select("term").distinct())
    found = postings.join(small(wanted.select("item_id", "term", "needed"), "wanted"), "term")
    ahead = Window.partitionBy("key", "item_id").orderBy("position").rangeBetween(0, within - 1)
    spans = found.withColumn("held", F.collect_set("term").over(ahead)).withColumn(
        "last", F.max(F.struct("position")).over(ahead)["position"])
    return spans.where(F.size("held") >= F.col("needed")).select(
        "key", "item_id", F.col("position").alias("first"), "last", F.col("needed").cast("int").alias("n_terms"))


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = 13, share: int = 20,
) -> DataFrame:
    """One row per document: words, words inside phrases of items, the items, and the verdict.

    ``contaminated``: at least one word in ``share`` is inside a phrase. The
    words of an item without an id count as hit; it has no name in the list.
    """
    own = keyed(docs, doc_id, text)
    # Items go by their words: two texts under one id stay apart, and items of the same words are looked up once.
    tests = items.select(F.xxhash64(words_of(F.col(item_text))).alias("item_id"), F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("text"))
    spans = write_once(exact_matches(own, tests.select("item_id", "text").dropDuplicates(["item_id"]), window), "matches")
    # Places of one document in order: a word counts where no earlier place has reached it.
    places = spans.select("key", "at", (F.col("at") + F.col("length")).alias("upto")).distinct()
    earlier = Window.partitionBy("key").orderBy("at", "upto").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("upto") - F.greatest(F.col("at"), F.coalesce(F.max("upto").over(earlier), F.lit(0))))
    hits = places.withColumn("fresh", fresh).groupBy("key").agg(F.sum("fresh").alias("n_hit"))
    named = spans.select("key", "item_id").distinct().join(small(tests.select("item_id", "name").distinct(), "names"), "item_id")
    found = named.groupBy("key").agg(F.sort_array(F.collect_set("name")).alias("ids"))
    per_key = small(hits.join(found, "key"), "hits")
    n_words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(ANY_CASE_WORD)).cast("bigint")
    return own.select("doc_id", "key", n_words.alias("n_words")).join(per_key, "key", "left").select(
        "doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("ids", F.array().cast("array<string>")).alias("item_ids"),
    ).withColumn("n_items", F.size("item_ids").cast("bigint")).withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
