"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessel.llm.common import SPACE, save, words_expr

WEIGHTS, MAX_EPOCHS, SEED = (5, 2, 1), 3, "mix-1"
BUCKET_DIGITS, STEPS = 4, 256  # of the hexadecimal order key: 65,536 buckets a source, in 256 coarse ones
BROADCAST_SOURCES = 50_000


def source_plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source (source, source_size, target, whole, rest): one row each, so its windows see sources, not documents.

    Sources by the ratio of cap to weight: those whose cap lies under the water level stop at it, and what
    they leave is shared by weight among the others. The first source over the level fixes it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "rank")
    so_far, from_here = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")).cast("double")
    plan = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", weight)
    plan = plan.withColumn("cap", (F.col("source_size") * max_epochs).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    total = F.sum("source_size").over(every).cast("double")
    plan = plan.withColumn("level", (total - F.coalesce(F.sum("cap").over(so_far), F.lit(0.0))) / F.sum("weight").over(from_here))
    first_over = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "rank", "level"))).over(every)["level"]
    plan = plan.withColumn("water", first_over).withColumn("target", F.when(F.col("ratio") > F.col("level"), F.least("cap", F.col("water") * F.col("weight"))).otherwise(F.col("cap")))
    goal = F.floor(F.col("target") + 0.5).cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("cast(floor(target + 0.5) as bigint) div source_size")).otherwise(F.lit(0)).cast("long")
    return plan.select("source", "source_size", "target", whole.alias("whole"), (goal - whole * F.col("source_size")).alias("rest"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, carry: str | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, repetitions, part) per row of ``docs`` (doc_id, source, text, any other columns).

    ``taken`` words are ``repetitions`` whole texts and then the first ``part`` words. A column named by ``carry`` comes
    along (first); others are left out.

    Every document is taken ``whole`` times, and then documents in the order of a seeded digest of their
    doc_id are taken once more until the source's rounded target is met exactly; the last of them is taken
    in part. So a source's taken words equal its rounded target and no document passes ``max_epochs`` times
    its size. Null text has size 0; null source is the last source; null doc_id has a fixed place; equal
    doc_id order by size, and equal rows are interchangeable. An empty table gives no rows.

    The order is found by sums over 256 coarse buckets of the digest, then over the 256 fine ones of the boundary;
    only a source's boundary bucket (one of 65,536) is ever sorted, so a source with a third of all rows is spread
    over all tasks.
    """
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    along = [carry] if carry else []
    base = docs.select(*along, "doc_id", "source", words_expr(F.col("text")).alias("size"), key.alias("key")).withColumn("bucket", F.conv(F.substring("key", 1, BUCKET_DIGITS), 16, 10).cast("int"))
    base = save(base, "sizes")
    buckets = base.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    buckets = save(buckets, "buckets")
    plan = source_plan(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)

    def edges(sums: DataFrame, plan: DataFrame, step: str) -> DataFrame:
        """For each source of the plan (with ``rest`` words left) the step that the last word lies in, and the words before it."""
        before = Window.partitionBy("source").orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        p, b = plan.alias("p"), sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).alias("b")
        inside = (F.col("b.before") <= F.col("p.left")) & (F.col("p.left") < F.col("b.before") + F.col("b.words"))
        return p.join(b, F.col("p.source").eqNullSafe(F.col("b.source")) & inside, "left").select("p.*", f"b.{step}", "b.before")

    coarse = buckets.groupBy("source", F.expr(f"bucket div {STEPS}").alias("coarse")).agg(F.sum("words").alias("words"))
    found = edges(coarse, plan.withColumn("left", F.col("rest")), "coarse").withColumnsRenamed({"coarse": "edge_coarse", "before": "edge_before"})
    fine = buckets.join(found.select(F.col("source").alias("_source"), "edge_coarse"), F.col("source").eqNullSafe(F.col("_source")) & (F.expr(f"bucket div {STEPS}") == F.col("edge_coarse"))).select("source", "bucket", "words")
    edge = edges(fine, found.withColumn("left", F.col("rest") - F.col("edge_before")), "bucket")
    edge = edge.select("source", "source_size", "target", "whole", "rest", F.col("bucket").alias("edge"), (F.col("edge_before") + F.col("before")).alias("edge_before"))
    plan = save(edge, "plan")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    rows = base.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    is_edge = F.col("bucket") == F.col("edge")
    rest = rows.where(~F.coalesce(is_edge, F.lit(False))).withColumn("more", F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(F.lit(0)))
    ahead = Window.partitionBy("source").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    cut = rows.where(is_edge).withColumn("ahead", F.col("edge_before") + F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    cut = cut.withColumn("more", F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("ahead")))).drop("ahead")
    taken = (F.col("whole") * F.col("size") + F.col("more")).cast("long")
    whole = F.col("whole") + (F.col("more") == F.col("size")).cast("long")
    part = F.when(F.col("more") == F.col("size"), 0).otherwise(F.col("more")).cast("long")
    return rest.unionByName(cut).select(*along, "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), whole.alias("repetitions"), part.alias("part"))


def part_text(text, part):
    """The first ``part`` words, joined by one space."""
    w = F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")
    return F.when(part > 0, F.array_join(F.slice(w, F.lit(1), part.cast("int")), " ")).otherwise(F.lit(""))
