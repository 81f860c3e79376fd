"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree over blocks of documents.

Documents of a source are dealt to blocks by hash. A source's target fixes how many of its blocks are drawn: whole
passes over all of them, then a permuted part of one more pass, whose last block is cut at a word. The tree splits the
sources' block quotas between two halves of the output shards, level by level, each split drawn without replacement;
a leaf holds a shard's exact quota per source, and takes that many of the source's permuted draws, disjoint from
every other shard's. Within a shard the order is by hash. DataFrame operations only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.llm.common import GAP, column, let, n_words, staged, text_or_empty

#: Blocks per output shard, on average; words of a shard, at most on average; shards there are at least.
BLOCKS_PER_SHARD, SHARD_WORDS, LEAST_SHARDS = 16, 1 << 24, 64
#: Levels of the tree that one task computes; deeper ones are dealt out by node.
TOP_LEVELS = 10
#: Source tables of up to so many rows are broadcast (their rows are counted first); longer ones are joined by shuffle.
SMALL_SOURCES = 10_000
#: Sources that one node of the tree splits at most; bits of a hash that part a source's running sums.
GROUP, PARTS = 512, 8


def _hash(*columns) -> Column:
    return F.xxhash64(*[c if isinstance(c, Column) else F.lit(c) for c in columns])


def _log_factorial(n: Column) -> Column:
    """Exact logarithms below 16, Stirling's series (error under 1e-9) from there."""
    small = F.split(F.lit(",".join(repr(math.lgamma(i + 1)) for i in range(16))), ",").cast("array<double>")  # folded into one literal

    def series(x: Column) -> Column:
        return x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)

    return let(n, lambda k: F.when(k < 16, F.element_at(small, F.least(k, F.lit(15)).cast("int") + 1)).otherwise(let(F.greatest(k, F.lit(16)).cast("double"), series)))


def _choose(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of `drawn` out of total are among the good ones: the inverse of the distribution at u, walked within 12 deviations."""
    d = lambda c: c.cast("double")
    share = d(good) / F.greatest(d(total), F.lit(1.0))
    spread = F.struct((d(drawn) * share).alias("mean"), F.sqrt(F.greatest(d(drawn) * share * (1 - share), F.lit(0.0))).alias("dev"))

    def ends(m: Column) -> Column:
        low = F.greatest(F.lit(0).cast("long"), drawn - (total - good), F.floor(m["mean"] - 12 * m["dev"] - 2))
        return F.struct(low.alias("low"), F.least(good, drawn, F.ceil(m["mean"] + 12 * m["dev"] + 2)).alias("high"), u.alias("u"))

    def walk(e: Column) -> Column:
        def step(s: Column, x: Column) -> Column:
            more = d(good - x) * d(drawn - x) / (d(x + 1) * F.greatest(d(total - good - drawn + x + 1), F.lit(1.0)))
            return let(s["p"] * more, lambda p: F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.when(s["c"] < e["u"], x + 1).otherwise(s["x"]).alias("x")))

        first = F.exp(_choose(good, e["low"]) + _choose(total - good, drawn - e["low"]) - _choose(total, drawn))
        start = let(first, lambda p: F.struct(p.alias("p"), p.alias("c"), e["low"].alias("x")))
        steps = F.sequence(e["low"], F.greatest(e["low"], e["high"] - 1))
        return F.when(e["high"] <= e["low"], e["low"]).otherwise(F.aggregate(steps, start, step, lambda s: s["x"]))

    return let(let(spread, ends), walk)


def _uniform(*columns) -> Column:
    return (F.shiftrightunsigned(_hash(*columns), 11).cast("double") + 0.5) / float(1 << 53)


def _halved(items: Column, want: Column, node: Column, seed: int) -> Column:
    """items (ix, k) drawn without replacement: k of each among the `want` that go left."""
    total = F.aggregate(items, F.lit(0).cast("long"), lambda a, x: a + x["k"])

    def start(t: Column) -> Column:
        return F.struct(t.alias("rest"), want.cast("long").alias("want"), F.array().cast("array<struct<ix:bigint,k:bigint>>").alias("out"))

    def draw(s: Column, x: Column) -> Column:
        got = hypergeometric(s["rest"], x["k"], s["want"], _uniform(seed, node, x["ix"]))
        return let(got, lambda g: F.struct((s["rest"] - x["k"]).alias("rest"), (s["want"] - g).alias("want"), F.concat(s["out"], F.array(F.struct(x["ix"].alias("ix"), g.alias("k")))).alias("out")))

    return let(total, lambda t: F.aggregate(items, start(t), draw, lambda s: s["out"]))


def _rest(items: Column, half: Column) -> Column:
    return F.zip_with(items, half, lambda a, b: F.struct(a["ix"].alias("ix"), (a["k"] - b["k"]).alias("k")))


def _some(items: Column) -> Column:
    return F.filter(items, lambda x: x["k"] > 0)


def splitting_tree(root: DataFrame, levels: int, seed: int) -> DataFrame:
    """root: rows (node, items: array of (ix, k)). Returns the leaves (node, items), whose k add up to the root's, item by item; none is 0.

    A node has half of its parent's draws (rounded down to the left).
    """
    total = F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x["k"])
    half = _halved(F.col("items"), F.floor(total / 2), F.col("node"), seed).alias("half")  # the same expression at every level
    both = F.inline(F.array(F.struct((F.col("node") * 2).alias("node"), _some(F.col("half")).alias("items")), F.struct((F.col("node") * 2 + 1).alias("node"), _some(_rest(F.col("items"), F.col("half"))).alias("items"))))
    for level in range(levels):
        if level == TOP_LEVELS:
            root = root.repartition("node")
        root = root.select("node", "items", half).select(both).filter(F.size("items") > 0)
    return root


def _split_groups(groups: DataFrame, levels: int, seed: int) -> DataFrame:
    """groups: rows (g, items, quotas: array of (shard, k)), whose k have one sum. Returns (ix, shard, k): a tree per group, its halves' sizes given by its quotas."""
    now = groups.withColumn("node", F.lit(1).cast("long"))
    want = F.aggregate("left", F.lit(0).cast("long"), lambda a, q: a + q["k"])
    half = _halved(F.col("items"), want, F.col("node"), seed).alias("half")  # the same expressions at every level
    one = lambda node, items, quotas: F.struct(node.alias("node"), _some(items).alias("items"), quotas.alias("quotas"))
    both = F.inline(F.array(one(F.col("node") * 2, F.col("half"), F.col("left")), one(F.col("node") * 2 + 1, _rest(F.col("items"), F.col("half")), F.col("right"))))
    for level in range(levels):
        bit = levels - 1 - level
        there = lambda side: F.filter("quotas", lambda q: F.shiftright(q["shard"], bit).bitwiseAND(F.lit(1).cast("long")) == side)  # noqa: B023, E731
        now = now.select("g", "node", "items", there(0).alias("left"), there(1).alias("right"))
        now = now.select("*", half).select("g", both).filter(F.size("items") > 0)
        if level == TOP_LEVELS:
            now = now.repartition("g", "node")
    return now.select((F.col("node") - (1 << levels)).alias("shard"), F.inline("items")).select("ix", "shard", "k")


def _listed(rows: DataFrame, by: str, item: str, amount: str, name: str, at: str) -> DataFrame:
    return rows.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(item).alias(at), F.col(amount).alias("k")))).alias(name))


def shard_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(ix, shard, k) with k > 0: how many of the n draws of each source (ix, n) every output shard gets, drawn without replacement.

    More than GROUP sources are split group by group: the groups' sums first, then each group's sums among its sources.
    """
    levels = shards.bit_length() - 1
    quotas = quotas.select(F.col("ix").cast("long").alias("ix"), "n")
    most = quotas.agg(F.max("ix")).first()[0]
    if most is None or most < GROUP:
        root = staged(_listed(quotas.withColumn("node", F.lit(1).cast("long")), "node", "ix", "n", "items", "ix"), "root")
        return splitting_tree(root, levels, seed).select((F.col("node") - shards).alias("shard"), F.inline("items")).select("ix", "shard", "k")
    grouped = quotas.withColumn("g", F.floor(F.col("ix") / GROUP))
    above = shard_quotas(grouped.groupBy(F.col("g").alias("ix")).agg(F.sum("n").alias("n")), shards, seed + 1)
    own = _listed(grouped, "g", "ix", "n", "items", "ix").join(_listed(above, "ix", "shard", "k", "quotas", "shard").withColumnRenamed("ix", "g"), "g")
    return _split_groups(staged(own, "groups").repartition("g"), levels, seed)


def _numbered(own: DataFrame, few: bool) -> DataFrame:
    """own (a row per source) with ix: its number by code point, null last."""
    if few:
        return own.withColumn("ix", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    # ranges, and the number of sources in the ranges before
    ranged = staged(own.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id()), "ranges")
    before = ranged.groupBy("range").count().withColumn("before", F.coalesce(F.sum("count").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())
    return ranged.join(F.broadcast(before.drop("count")), "range").withColumn("ix", F.col("before") + F.row_number().over(inside) - 1).drop("range", "before")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Per source: its number (by code point, null last), words, rows, and target: shares by weight, none above most times its words.

    A unit of weight gets what the sources that aren't full leave, over their weights; filling those that are then above
    their cap raises it, until none is. Only sums reach the driver.
    """
    own = staged(sizes.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n_rows")), "source-sizes")
    n, all_words, all_rows = own.agg(F.count("*"), F.sum("words"), F.sum("n_rows")).first()
    ranked = _numbered(own, n <= SMALL_SOURCES)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("ix") % len(weights) + 1).cast("int")).cast("double")).withColumn("cap", F.col("words") * float(most))
    ranked = staged(ranked, "ranked")
    unit, full = None, -1
    while n:
        above = F.lit(False) if unit is None else F.col("cap") <= unit * F.col("weight")
        caps, rest, now = ranked.agg(F.sum(F.when(above, F.col("cap")).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))), F.count_if(above)).first()
        if now == full or not rest:
            unit = unit if rest else float("inf")
            break
        unit, full = (all_words - caps) / rest, now
    target = F.least("cap", F.lit(unit if n else 0.0) * F.col("weight"))
    return ranked.withColumn("target", target).withColumn("all_words", F.lit(all_words or 0)).withColumn("all_rows", F.lit(all_rows or 0)).drop("cap")


def _running(df: DataFrame, by: str, order: Column, ties: list[str], value: Column, name: str) -> DataFrame:
    """df with, under name, the sum of value over the rows before in (order, ties), per `by`.

    The order is a hash; sums inside its PARTS ranges and sums of the ranges before add up, so one `by` takes many tasks.
    """
    own = df.withColumn("_order", order).withColumn("_part", F.shiftright("_order", 64 - PARTS))
    inside = Window.partitionBy(by, "_part").orderBy("_order", *ties).rowsBetween(Window.unboundedPreceding, -1)
    parts = own.groupBy(by, "_part").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(by, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    own = own.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return own.join(parts, [by, "_part"]).withColumn(name, (F.col(name) + F.col("_before")).cast("long")).drop("_order", "_part", "_before")


def _drawn(own: DataFrame, weights: tuple[int, ...], most: int, shards: int | None, seed: int) -> DataFrame:
    """own (key, source, size, mark and others) with words, target and draws; own is read twice."""
    sizes = staged(own.select("key", "source", "size", "mark"), "sizes")
    if shards is None:
        words = sizes.agg(F.sum("size")).first()[0] or 0
        shards = max(LEAST_SHARDS, 1 << math.ceil(math.log2(max(1, words / SHARD_WORDS))))
    if shards & (shards - 1):
        raise ValueError("shards: a power of two")
    sources = source_targets(sizes, weights, most)
    n_blocks = float(shards * BLOCKS_PER_SHARD)
    share = F.greatest(F.col("words") / F.greatest("all_words", F.lit(1)), F.col("n_rows") / F.greatest("all_rows", F.lit(1)))
    full = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("long")
    sources = sources.withColumn("blocks", F.greatest(F.lit(1), F.ceil(share * n_blocks)).cast("long")).withColumn("full", full)
    part = F.least(F.col("words"), F.greatest(F.lit(0), F.round("target").cast("long") - F.col("full") * F.col("words")))
    sources = staged(sources.withColumn("part", part).drop("all_words", "all_rows", "weight", "n_rows"), "sources")
    few = F.broadcast(sources) if sources.count() <= SMALL_SOURCES else sources

    def dealt(rows: DataFrame) -> DataFrame:
        met = rows.join(few.select(F.col("source").alias("of"), "ix", "words", "target", "blocks"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
        return met.withColumn("block", F.pmod(_hash(seed, 1, F.col("key"), F.col("mark")), F.col("blocks"))).drop("blocks")

    blocks = staged(dealt(sizes).groupBy("ix", "block").agg(F.sum("size").alias("block_words")).filter("block_words > 0"), "blocks")
    blocks = _running(blocks, "ix", _hash(seed, 2, F.col("ix"), F.col("block")), ["block"], F.col("block_words"), "before")
    blocks = blocks.join(few.select("ix", "full", "part"), "ix")
    whole = F.transform(F.sequence(F.lit(1).cast("long"), F.greatest("full", F.lit(1))), lambda p: F.struct(p.alias("pass"), F.col("block_words").alias("quota")))
    last = F.array(F.struct((F.col("full") + 1).alias("pass"), F.least(F.col("block_words"), F.col("part") - F.col("before")).alias("quota")))
    passes = F.concat(F.when(F.col("full") > 0, whole).otherwise(F.slice(last, 1, 0)), F.when(F.col("part") > F.col("before"), last).otherwise(F.slice(last, 1, 0)))
    draws = staged(blocks.select("ix", "block", F.inline(passes)), "passes")
    order = _hash(seed, 3, F.col("ix"), F.col("block"), F.col("pass"))
    draws = staged(_running(draws, "ix", order, ["block", "pass"], F.lit(1), "rank"), "draws")

    leaves = staged(shard_quotas(draws.groupBy("ix").agg(F.count("*").alias("n")), shards, seed), "leaves")
    leaves = _running(leaves, "ix", _hash(seed, 6, F.col("ix"), F.col("shard")), ["shard"], F.col("k"), "from")
    taken = leaves.select("ix", "shard", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("k") - 1)).alias("rank"))
    placed = draws.join(taken, ["ix", "rank"]).groupBy("ix", "block").agg(F.array_sort(F.collect_list(F.struct("pass", "shard", "quota"))).alias("drawn"))

    inside = Window.partitionBy("ix", "block").orderBy(_hash(seed, 4, F.col("key"), F.col("mark")), "key", "mark", "size")
    ahead = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    out = dealt(own).withColumn("ahead", ahead).join(placed, ["ix", "block"], "left")
    own_words = F.transform("drawn", lambda d: F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"), F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), d["quota"] - F.col("ahead"))).alias("words")))
    own_words = F.coalesce(F.filter(own_words, lambda d: d["words"] > 0), F.array().cast("array<struct<pass:bigint,shard:bigint,words:bigint>>"))
    return out.select(*own.columns, "words", "target", own_words.alias("draws"))


def mixture(df: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, shards: int | None = None, seed: int = 0, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row of df: key, source, size (words), source_size, target, taken (words, repeats counted), draws.

    draws lists (pass, shard, words) of each time the row is drawn; words is below size only for one row per source,
    which is cut there. So a source's taken words are its target, rounded, and no row exceeds most times its size.
    A null text has size 0 and is never drawn; a null source is a source of its own, the last; a null key hashes like
    any value. Repeated rows, and rows that share a key, are rows of their own. Reruns agree. An empty table gives none.
    shards: a power of two; by default one for every SHARD_WORDS words, so that shards stay of a size however large the
    table is. Other columns are not read.
    """
    own = df.select(column(key).alias("key"), column(source).alias("source"), text_or_empty(column(text)).alias("text"))
    own = staged(own.select("key", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("mark")), "rows")
    out = _drawn(own, weights, most, shards, seed)
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    return out.select(F.col("key").alias(key), F.col("source").alias(source), "size", F.col("words").alias("source_size"), "target", taken.alias("taken"), "draws")


def mix(df: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, shards: int | None = None, seed: int = 0, key: str = "doc_id", text: str = "text", source: str = "source", length: str | None = "n_chars") -> DataFrame:
    """The mixed rows: df's columns, once per draw, shard after shard, shuffled within each; draws as in mixture.

    A row that is cut keeps its first words, joined by single spaces, and its new length (in code points, where df has
    that column). Rows travel as they are, so null and repeated keys, repeated rows and any names of columns are fine.
    """
    own = df.select(F.struct("*").alias("row"), column(key).alias("key"), column(source).alias("source"), text_or_empty(column(text)).alias("text"))
    own = own.select("row", "key", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("mark"))
    rows = _drawn(own, weights, most, shards, seed).select("row", "key", "mark", "size", F.inline("draws"))
    whole = rows.select("shard", _hash(seed, 5, F.col("key"), F.col("mark"), F.col("pass")).alias("order"), "row", "words", (F.col("words") < F.col("size")).alias("cut"))
    whole = whole.repartition("shard").sortWithinPartitions("shard", "order")
    own_text = F.col("row").getField(text)
    short = F.array_join(F.slice(F.split(F.regexp_replace(own_text, f"^{GAP}+", ""), f"{GAP}+"), F.lit(1), F.col("words").cast("int")), " ")

    def made(c: str) -> Column:
        own = F.col("row").getField(c)
        if c == text:
            return F.when(F.col("cut"), short).otherwise(own)
        return F.when(F.col("cut"), F.length(short).cast(df.schema[c].dataType)).otherwise(own) if c == length else own

    return whole.select(*[made(c).alias(c) for c in df.columns])
