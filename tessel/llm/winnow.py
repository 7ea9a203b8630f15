"""Benchmark decontamination by winnowing, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import few, save

WINDOW, GRAM, BROADCAST_ROWS = 10, 4, 500_000
#: What separates words, in any case, and the letters of the step to lower case.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words with A-Z in lower case; ``lower`` does just that where all characters are ASCII."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, SEPARATOR), "")


def up_to(n: Column) -> Column:
    """0 to n; empty for a negative n."""
    return F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))


def grams(w: Column, k: int) -> Column:
    """The hash of the k words from each place on."""
    return F.transform(up_to(F.size(w) - k), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(k))))


def minima(g: Column, span: int) -> Column:
    """The distinct minimum hashes of ``span`` consecutive ones: the winnowed fingerprints. ``g`` must be a column of its own, or each step makes it anew."""
    return F.array_distinct(F.transform(up_to(F.size(g) - span), lambda i: F.array_min(F.slice(g, i + 1, span))))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) and ``benchmark`` (item_id, text) -> (doc_id, n_words, n_hit, n_items, items_sha256, contaminated), a row per row of docs.

    Of every ``window - gram + 1`` consecutive hashes of ``gram`` words the minimum is a fingerprint, so
    every shared span of ``window`` words has one on both sides. Texts that share one are candidates; each
    common gram is extended to the windows around it, which are found among the items' windows by hash and
    compared word by word. Items of fewer words are one window each, found by the hash of all their words.

    Null and empty texts have no words and are never hit; items without words match nothing, and items
    without item_id hit words but are not listed. Repeated rows of either table give what one gives; empty tables
    give no rows, or no hits. Other columns are left out. Texts are scanned once, and again only those of candidates;
    candidates and results are keyed by text, so copies are judged once. A gram or window that many
    items and documents hold gives a row for each place in a document, whatever the items.
    """
    span = window - gram + 1
    items = save(benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("iw")).where(F.size("iw") > 0), "items")
    long_items = items.where(F.size("iw") >= window)
    prints = save(long_items.select(grams(F.col("iw"), gram).alias("g")).select(F.explode(minima(F.col("g"), span)).alias("fp")).distinct(), "prints")
    cuts = lambda w, m: F.transform(up_to(F.size(w) - m), lambda s: F.slice(w, s + 1, m))

    def listed(rows: DataFrame, m: int) -> DataFrame:
        """(wh, win, ids): each window of the items once, with the items that hold it."""
        each = rows.select("item_id", F.explode(F.array_distinct(cuts(F.col("iw"), m))).alias("win"))
        return save(each.groupBy(F.xxhash64("win").alias("wh"), "win").agg(F.collect_set("item_id").alias("ids")), f"windows_{m}")

    lengths = sorted(r[0] for r in items.where(F.size("iw") < window).select(F.size("iw")).distinct().collect())  # at most window - 1 values
    sought = {m: listed(items.where(F.size("iw") == m), m) for m in lengths}
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))
    scan = named.select("doc_id", "t1", "t2", words(F.col("text")).alias("w"))
    shorts = [F.array_distinct(F.transform(cuts(F.col("w"), m), lambda x: F.xxhash64(x))).alias(f"g{m}") for m in lengths]
    scan = scan.select("doc_id", "t1", "t2", F.size("w").cast("long").alias("n_words"), grams(F.col("w"), gram).alias("g"), *shorts)
    scan = save(scan.withColumn("g", minima(F.col("g"), span)), "scan")
    candidates = scan.select("t1", "t2", F.explode("g").alias("fp")).join(few(prints, BROADCAST_ROWS), "fp", "left_semi").select("t1", "t2")
    for m in lengths:
        found = scan.select("t1", "t2", F.explode(f"g{m}").alias("wh")).join(few(sought[m].select("wh"), BROADCAST_ROWS), "wh", "left_semi")
        candidates = candidates.union(found.select("t1", "t2"))
    candidates = save(candidates.distinct(), "candidates")

    chosen = named.join(few(candidates, BROADCAST_ROWS), ["t1", "t2"], "left_semi").groupBy("t1", "t2").agg(F.first("text").alias("text"))
    chosen = save(chosen.select("t1", "t2", words(F.col("text")).alias("w")), "candidate_words")
    common = chosen.select("t1", "t2", F.posexplode(grams(F.col("w"), gram)).alias("p", "fp")).join(few(prints, BROADCAST_ROWS), "fp", "left_semi")
    around = common.select("t1", "t2", F.explode(F.sequence(F.col("p") - span + 1, F.col("p"))).alias("s")).where("s >= 0")
    around = around.groupBy("t1", "t2").agg(F.collect_set("s").alias("starts"))
    near = chosen.join(around, ["t1", "t2"]).select("t1", "t2", F.explode(F.transform(F.filter("starts", lambda s: s + window <= F.size("w")), lambda s: F.struct(s.alias("s"), F.slice("w", s + 1, window).alias("win")))).alias("x"))
    places = {window: near.select("t1", "t2", "x.s", "x.win")} | {m: chosen.select("t1", "t2", F.posexplode(cuts(F.col("w"), m)).alias("s", "win")) for m in lengths}
    sought[window] = listed(long_items, window)
    hits = None
    for m, rows in places.items():
        found = rows.withColumn("wh", F.xxhash64("win")).join(few(sought[m], BROADCAST_ROWS // 10), ["wh", "win"]).select("t1", "t2", "s", F.lit(m).alias("m"), "ids")
        hits = found if hits is None else hits.unionByName(found)

    hit_words = F.size(F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("s", "m")), lambda x: F.sequence(x["s"], x["s"] + x["m"] - 1)))))
    result = hits.groupBy("t1", "t2").agg(hit_words.cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items"))
    ids = F.coalesce(F.array_join("items", ","), F.lit(""))
    return scan.select("doc_id", "t1", "t2", "n_words").join(few(save(result, "hits"), BROADCAST_ROWS // 5), ["t1", "t2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )
