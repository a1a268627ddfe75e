"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

The target of a source is min(cap, level * weight), where one level makes the targets add up
to the budget: clamping sources at their cap and sharing the excess by weight until nothing
is above its cap ends at just this level. It is found in one pass over the sources ordered
by cap / weight, the order in which they clamp.

Each source then takes floor(target / size) whole repetitions of all its documents, and the
rest from a seeded order of its documents, as far as the rest reaches (to half of the
document on its edge). The order's running totals come in two levels, by hash range and
within the one range where the rest ends, so that no task orders a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, null_safe, restored, safe, small, staged, table

#: Hash ranges of a source.
RANGES = 4096


def weigh(sources: DataFrame, col: str = "source", cycle: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Adds weight: the cycle's numbers dealt out in the sources' order by code point, null last."""
    place = F.row_number().over(Window.orderBy(F.col(col).asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (place % len(cycle) + 1).cast("int")).cast("double"))


def water_fill(sources: DataFrame, share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """Adds target to rows of (source, source_size, weight): share times all sizes, none above max_epochs times its size.

    If the caps add up to less than the budget, every target is its cap. Sources of weight 0
    get 0. One row for each source, in one task.
    """
    every = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    capped = sources.where("weight > 0").withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    clamped = F.coalesce(F.sum("cap").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weights = F.sum("weight").over(every.rowsBetween(0, Window.unboundedFollowing))
    budget = F.lit(share) * F.sum("source_size").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    steps = capped.withColumn("step_level", (budget - clamped) / weights)
    # the first source that the remaining budget doesn't fill sets the level of all from it on
    open_ = F.when(F.col("step_level") * F.col("weight") <= F.col("cap"), F.col("step_level"))
    level = F.first(open_, ignorenulls=True).over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    filled = steps.withColumn("level", level).withColumn("target", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight"))))
    none = sources.where("not coalesce(weight > 0, false)").withColumn("target", F.lit(0.0))
    return filled.select(*sources.columns, "target").unionByName(none)


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", share: float = 1.5, max_epochs: float = 2.0, carry: bool = True) -> DataFrame:
    """df with size, source_size, target and copies: how often the mix takes each row.

    Null texts have size 0; null sources are a source; null ids order as an empty string.
    Texts of any length count whole; an empty table gives an empty result. Rows that agree in
    id, size and text hash are interchangeable, and all rows of one id order in one task.
    Columns of df of the added names are replaced. carry=False returns no other columns than id and source beside these.
    """
    own = df.columns if carry else [id_col, source_col]
    text = F.coalesce(F.col("__text"), F.lit(""))
    sized = df.select(*safe(df, own), F.col(id_col).alias("__id"), F.col(source_col).alias("__s"), F.col(text_col).alias("__text")).withColumns({
        "size": F.regexp_count(text, F.lit(WORD)).cast("long"),
        "__h": F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("__id").cast("string"), F.lit(""))).cast("binary")), 1, 15), 16, 10).cast("long"),
        "__t": F.xxhash64(text),
    })
    sized = sized.withColumn("__range", F.shiftright("__h", 48).cast("int"))
    if not carry:
        sized = staged(sized.drop("__text"), "mix-sizes")

    ranges = staged(sized.groupBy(F.col("__s").alias("source"), "__range").agg(F.sum("size").alias("s")), "mix-ranges")
    sources = ranges.groupBy("source").agg(F.sum("s").alias("source_size"))
    filled = water_fill(weigh(sources), share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    filled = filled.withColumn("whole", whole).withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    filled = filled.withColumn("rest", F.when(F.col("whole") >= max_epochs, 0.0).otherwise(F.col("rest")))
    # the range of a source in which its rest ends, and the words before it
    upto = F.coalesce(F.sum("s").over(Window.partitionBy("source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = null_safe(ranges.withColumn("before", upto), filled.select("source", "rest"), "source").where("before < rest").groupBy("source").agg(F.max(F.struct("__range", "before")).alias("cut"))
    plan = null_safe(filled, cut, "source", "left").select("source", "source_size", "target", "whole", "rest", F.coalesce("cut.__range", F.lit(-1)).alias("cut"), F.coalesce("cut.before", F.lit(0)).alias("before"))
    plan = small(staged(plan, "mix-plan"))

    rows = null_safe(sized, plan.withColumnRenamed("source", "__s"), "__s")
    clear = rows.where("__range <> cut").withColumn("copies", F.col("whole") + F.when(F.col("__range") < F.col("cut"), 1).otherwise(0))
    run = Window.partitionBy("__s").orderBy("__h", "__id", "size", "__t").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where("__range = cut").withColumn("__b", F.col("before") + F.coalesce(F.sum("size").over(run), F.lit(0)))
    edge = edge.withColumn("copies", F.col("whole") + F.when(2 * F.col("__b") + F.col("size") <= 2 * F.col("rest"), 1).otherwise(0)).drop("__b")
    both = clear.unionByName(edge).withColumn("copies", F.col("copies").cast("long"))
    return restored(both, own, ["size", "source_size", "target", "copies"])


def repeat(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each row as often as its copies say."""
    return mixed.where("copies > 0").withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*columns)


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), carry=False)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source")


OP1_SQL = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text,''), '[^\x20\x09-\x0D]+'))::bigint as size,
                  ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar,'')),1,15))::bigint as h from documents),
     s as (select source, sum(size)::bigint as source_size from d group by source),
     w as (select *, [5,2,1][((row_number() over (order by source nulls last)) - 1) % 3 + 1]::double as weight, 2.0e0*source_size as cap from s),
     l as (select *, (1.5e0 * (sum(source_size) over ())::double - coalesce(sum(cap) over (order by cap/weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
                     / sum(weight) over (order by cap/weight, source nulls last rows between current row and unbounded following) as step_level from w),
     v as (select *, (select arg_min(step_level, cap/weight) from l where step_level*weight <= cap) as level from l),
     t as (select source, source_size, case when level is null then cap else least(cap, level*weight) end as target from v),
     e as (select *, case when source_size > 0 then floor(target/source_size) else 0 end as whole from t),
     r as (select d.doc_id, d.source, d.size, e.source_size, e.target, e.whole, case when e.whole >= 2 then 0 else greatest(0, e.target - e.whole*e.source_size) end as rest,
                  coalesce(sum(d.size) over (partition by d.source order by d.h, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0) as b
           from d join e on d.source is not distinct from e.source)
select doc_id, size, source_size, target, ((whole + case when 2*b + size <= 2*rest then 1 else 0 end)*size)::bigint as taken,
       (whole + case when 2*b + size <= 2*rest then 1 else 0 end)::bigint as copies, source from r
"""
