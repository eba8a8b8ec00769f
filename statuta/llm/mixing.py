"""Mixing sources to target weights by capped water-filling and seeded repetitions.

Sources ask for shares of the whole in proportion to their weights. A source
whose share exceeds ``max_epochs`` times its size is clamped there and the
excess is reshared among the others by weight until none is above. Every
document of a source is then taken floor(rate) times, and one time more if it
comes early enough in the source's seeded order for the source to meet its
target: the cut is found through two levels of hash-range sums, so no task
ever orders a whole source. Rows that are equal in doc_id, source and text
share a place; where the cut falls among them, as many of them are taken as
the target asks for, chosen through ranges of their row numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, stored

MAX_EPOCHS = 3
SEED = 17
#: Hash ranges at each of the two levels: the first and second eight of the hash's 60 bits.
RANGES = 256


def word_count(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in text: starts of words, counted without building them."""
    flat = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.coalesce(F.regexp_count(flat, F.lit("[^ ]+")), F.lit(0)).cast("long")


def water_filling(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """sizes (source, source_size) -> rows (source, source_size, target).

    Weights repeat over sources in code-point order, null last. The clamped
    sources are those with the least cap per weight: walking up that order,
    source i is clamped while its cap is below its share of what the clamped
    ones leave. One row per source takes part; sources without words get 0.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = F.row_number().over(order) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (k % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("total", F.sum("source_size").over(everything)).withColumn("all_w", F.sum("w").over(everything))
    s = s.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    s = s.withColumn("level", (F.col("total") - F.col("cap_before")) / (F.col("all_w") - F.col("w_before")))
    s = s.withColumn("clamped", F.col("cap") <= F.col("level") * F.col("w"))
    free = F.min(F.when(~F.col("clamped"), F.struct(F.col("w_before"), F.col("level")))).over(everything)
    return s.select("source", "source_size", F.when(F.col("clamped"), F.col("cap")).otherwise(free["level"] * F.col("w")).alias("target"))


def _placed(docs: DataFrame, seed: int) -> DataFrame:
    """docs with _size, and the document's place in its source's seeded order: _h and its two ranges _k1, _k2."""
    empty = F.lit("")
    text = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), empty), F.coalesce(F.col("source").cast("string"), empty), F.md5(F.coalesce("text", empty).cast("binary")))
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")  # 60 bits
    d = docs.withColumn("_size", word_count(F.col("text"))).withColumn("_h", h)
    return d.withColumn("_k1", F.shiftright("_h", 52).cast("int")).withColumn("_k2", F.pmod(F.shiftright("_h", 44), F.lit(RANGES)).cast("int"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken, copies), one for each row of docs (doc_id, text, source, ...).

    size: words of the text (null or empty: 0; such a document takes 0 words).
    copies: times the document is taken; taken = size * copies. Null sources
    are one source. Null and repeated doc_ids take places of their own by
    their texts; rows equal in id, source and text share one, and the cut may
    take some of them. Other columns are ignored. An empty table gives no
    rows. The same rows and seed give the same result however the table is
    partitioned (of equal rows, as many are taken).
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    slim = stored(_placed(slim, seed).drop("text"), "mixing")
    out = _copied(slim, _limits(slim, weights, max_epochs), max_epochs)
    return out.select("doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("_copies")).alias("taken"), F.col("_copies").alias("copies"), "source")


def repeat(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: every row of docs, with all its columns, as many times as mix() takes it."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    slim = stored(_placed(slim, seed).drop("text"), "mixing")
    limits = _limits(slim, weights, max_epochs)
    discard(slim)
    whole = docs.select("doc_id", "source", "text", F.struct("*").alias("_all"))
    out = _copied(_placed(whole, seed), limits, max_epochs)
    return out.select("_all", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))).select("_all.*")


def _limits(slim: DataFrame, weights: tuple[float, ...], max_epochs: float) -> DataFrame:
    """For each source: source_size, target, whole repetitions, what is left (more) and where the order is cut for it."""
    slim = slim.select("source", "doc_id", F.col("_size").alias("size"), F.col("_h").alias("h"), F.col("_k1").alias("k1"), F.col("_k2").alias("k2"))
    level1 = stored(slim.groupBy("source", "k1").agg(F.sum("size").alias("words")), "mixing-ranges")
    targets = water_filling(level1.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate + F.lit(1e-12))
    targets = targets.withColumn("whole", whole).withColumn("more", F.greatest(F.lit(0.0), F.col("target") - whole * F.col("source_size")))
    targets = stored(targets, "mixing-targets")

    def cut(sums: DataFrame, left: DataFrame, keys: list[str], order: list) -> DataFrame:
        """For each source the first range that reaches what is left to take, and what is left within it."""
        joined = sums.join(left, sums["source"].eqNullSafe(left["source"])).select(sums["source"], *keys, "words", "more")
        w = Window.partitionBy("source").orderBy(*order)
        run = joined.withColumn("upto", F.sum("words").over(w)).where("upto >= more")
        first = run.withColumn("r", F.row_number().over(w)).where("r = 1")
        return first.select("source", *keys, (F.col("more") - (F.col("upto") - F.col("words"))).alias("more"))

    part = targets.where("more > 0").select("source", "more")
    cut1 = cut(level1, part, ["k1"], ["k1"])
    a = slim.alias("a")
    in1 = a.join(cut1.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.k1") == F.col("b.k1")), "left_semi")
    level2 = in1.groupBy("source", "k2").agg(F.sum("size").alias("words"))
    cut2 = stored(cut(level2, cut1.select("source", "more"), ["k2"], ["k2"]).join(cut1.select(F.col("source").alias("s1"), "k1"), F.col("source").eqNullSafe(F.col("s1"))).select("source", "k1", "k2", "more"), "mixing-cut")
    b = cut2.alias("b")
    last = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.k1") == F.col("b.k1")) & (F.col("a.k2") == F.col("b.k2")))
    # rows of one place are equal, so the order is one of places
    places = last.groupBy("a.source", "a.h").agg(F.first("a.size").alias("size"), F.sum("a.size").alias("words"), F.count("*").alias("rows"), F.first("b.more").alias("more"))
    run = Window.partitionBy("source").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    left = F.col("more") - (F.sum("words").over(run) - F.col("words"))
    some = F.when(F.col("size") == 0, F.when(left >= 0, F.col("rows")).otherwise(0)).otherwise(F.greatest(F.lit(0), F.least(F.col("rows"), F.floor(left / F.col("size") + 0.5))))
    taken = places.withColumn("quota", some.cast("long")).where("quota > 0")
    end = taken.groupBy("source").agg(F.max(F.struct("h", "quota", "rows")).alias("end"))
    limits = targets.alias("t").join(b, F.col("t.source").eqNullSafe(F.col("b.source")), "left").join(end.alias("e"), F.col("t.source").eqNullSafe(F.col("e.source")), "left")
    limits = limits.select(F.col("t.source").alias("_of"), "t.source_size", "t.target", "t.whole", "t.more", F.col("b.k1").alias("c1"), F.col("b.k2").alias("c2"), "e.end")
    out = stored(limits, "mixing-limits")
    discard(level1, targets, cut2)
    return out


def _copied(placed: DataFrame, limits: DataFrame, max_epochs: float) -> DataFrame:
    """placed with source_size, target and _copies; limits has a row for each source."""
    same1, same2, at_end = F.col("_k1") == F.col("c1"), F.col("_k2") == F.col("c2"), F.col("_h") == F.col("end.h")
    early = F.when(F.col("more") <= 0, False).when(F.col("c1").isNull(), True).otherwise((F.col("_k1") < F.col("c1")) | (same1 & ((F.col("_k2") < F.col("c2")) | (same2 & F.coalesce(F.col("_h") <= F.col("end.h"), F.lit(False))))))
    joined = placed.join(limits, placed["source"].cast("string").eqNullSafe(limits["_of"])).withColumn("_early", early.cast("long"))
    if not limits.where("end.quota < end.rows").isEmpty():
        # the cut falls among equal rows: these are set aside, and as many as it asks for are early
        cut = F.coalesce(same1 & same2 & at_end & (F.col("end.quota") < F.col("end.rows")), F.lit(False))
        aside = stored(joined.where(cut).withColumn("_number", F.monotonically_increasing_id()), "mixing-equal")
        joined = joined.where(~cut).unionByName(_first(aside).drop("_number"))
    return joined.withColumn("_copies", F.least(F.ceil(F.lit(float(max_epochs))).cast("long"), F.col("whole") + F.col("_early")).cast("long"))


def _first(rows: DataFrame) -> DataFrame:
    """rows of one place for each source (_of), numbered: _early is 1 for end.quota of them, the first by a hash of the number.

    Counts of 65,536 hash ranges tell in which range the last one lies, so only the rows of one range are ordered.
    """
    d = rows.withColumn("_u", F.xxhash64("_number")).withColumn("_r", F.shiftrightunsigned("_u", 48))
    counts = d.groupBy(F.col("_of").alias("s"), F.col("_r").alias("r")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("s").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("before", F.sum("n").over(w) - F.col("n"))
    d = d.join(counts, F.col("_of").eqNullSafe(F.col("s")) & (F.col("_r") == F.col("r")))
    place = F.row_number().over(Window.partitionBy("_of", "_r").orderBy("_u", "_number"))
    left = F.col("end.quota") - F.col("before")
    sure = d.where((left <= 0) | (left >= F.col("n"))).withColumn("_early", (left > 0).cast("long"))
    last = d.where((left > 0) & (left < F.col("n"))).withColumn("_early", (place <= left).cast("long"))
    return sure.unionByName(last).drop("_u", "_r", "s", "r", "n", "before")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || substr(md5('17|' || coalesce(doc_id::varchar, '') || '|' || coalesce(source, '') || '|' || md5(coalesce(text, ''))), 1, 15))::bigint as h
  from documents),
s as (
  select source, source_size, source_size * 3.0::double as cap,
         (1 + (row_number() over (order by source nulls last) - 1) % 3)::double as w
  from (select source, sum(size)::bigint as source_size from d group by source)),
f as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over before, 0))
            / (sum(w) over () - coalesce(sum(w) over before, 0)) as level
  from s window before as (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding)),
c as (select *, cap <= level * w as clamped from f),
t as (
  select source, source_size,
         case when clamped then cap
              else (select arg_min(level, cap / w) from c where not clamped) * w end as target
  from c),
r as (
  select *, case when source_size > 0 then floor(target / source_size + 1e-12) else 0 end as whole from t),
m as (
  select doc_id, size, source_size, target, whole, greatest(0, target - whole * source_size) as more,
         sum(size) over (partition by d.source order by h, doc_id, size rows unbounded preceding) - size / 2.0 as middle
  from d join r on d.source is not distinct from r.source)
select doc_id, size, source_size, target,
       (size * least(3, whole + case when more > 0 and middle <= more then 1 else 0 end))::bigint as taken
from m
"""
