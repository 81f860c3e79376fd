"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in DataFrame operations only.

A paragraph is a line, cut after every PIECE words. Its digest enters one cell in each of three rows of a sketch; a cell
has the count, the XOR and the XOR of check hashes of its digests. Two sketches subtract cell by cell, and digests that
both have vanish. Cells left with one digest give it away; taking it out of its other cells peels the next, until the
difference is empty (recovered) or stuck. Stuck differences are tried again larger: digests are dealt to bins by other
bits, a sketch per bin, and a stuck bin's sketch grows.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tesserae.llm.common import column, let, text_or_empty

PIECE = 12
#: Cells in a row of a sketch, and the digest bits that place in its three rows, at each try; bins use bits from BIN up,
#: groups of bins the GROUP_BITS bits from GROUP up.
TRIES = ((8, (0, 3, 6)), (8, (9, 12, 15)), (32, (18, 23, 28)), (128, (19, 26, 33)))
BIN, GROUP, GROUP_BITS = 48, 40, 8
#: Digests of both sides a bin has on average at the second try.
BIN_LOAD = 8
#: Ordered documents meet their neighbours in buckets of about so many rows; there are at most so many buckets.
BUCKET_ROWS, MOST_BUCKETS = 1024, 1 << 16


def digests(text: Column) -> Column:
    """The distinct 64-bit digests of a text's paragraphs."""
    word, gap = r"[^\x20\x09-\x0D]++", r"[\x20\x09\x0B-\x0D]*+"
    pieces = F.regexp_extract_all(text, F.lit(f"(?:{word}{gap}){{1,{PIECE}}}"), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(F.rtrim(p))))


def _slot(x: Column, size: int, shift: int) -> Column:
    return F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(size - 1)).cast("int")


def _cell(n: Column, x: Column, c: Column) -> Column:
    return F.struct(n.alias("n"), x.alias("x"), c.alias("c"))


def entries(keys: Column, attempt: int = 0) -> Column:
    """Digests with their check hash and their cell in each row, so that building and peeling only compare numbers."""
    size, shifts = TRIES[attempt]
    return F.transform(keys, lambda k: F.struct(k.alias("x"), F.hash(k).alias("c"), F.lit(1).alias("n"), *[_slot(k, size, s).alias(f"s{i}") for i, s in enumerate(shifts)]))


def _merged(cell: Column, some: Column, row: int, j: Column, sign: int) -> Column:
    """A cell with those of some entries that fall into place j of a row put in (or taken out, sign -1)."""
    here = F.filter(some, lambda e: e[f"s{row}"] == j)
    return F.aggregate(here, cell, lambda a, e: _cell(a["n"] + e["n"] * sign if sign < 0 else a["n"] + e["n"], a["x"].bitwiseXOR(e["x"]), a["c"].bitwiseXOR(e["c"])))


def sketch(keys: Column, attempt: int = 0) -> Column:
    """The three rows of cells of an array of digests: struct(r0, r1, r2)."""
    size = TRIES[attempt][0]
    zero = _cell(F.lit(0), F.lit(0).cast("long"), F.lit(0))
    places = F.sequence(F.lit(0), F.lit(size - 1))

    def row(own: Column, r: int) -> Column:
        return F.transform(places, lambda j: _merged(zero, own, r, j, 1)).alias(f"r{r}")

    return let(entries(keys, attempt), lambda own: F.struct(*[row(own, r) for r in range(3)]))


def cells(rows: Column) -> Column:
    return F.concat(rows["r0"], rows["r1"], rows["r2"])


def subtract(a: Column, b: Column) -> Column:
    one = lambda s, r: F.zip_with(s["a"][r], s["b"][r], lambda p, q: _cell(p["n"] - q["n"], p["x"].bitwiseXOR(q["x"]), p["c"].bitwiseXOR(q["c"])))
    return let(F.struct(a.alias("a"), b.alias("b")), lambda s: F.struct(*[one(s, r).alias(r) for r in ("r0", "r1", "r2")]))


def peel(rows: Column, attempt: int = 0, rounds: int = 16) -> Column:
    """(ok, a, b) of a difference: whether it was recovered whole, and how many digests only either side has."""
    size, shifts = TRIES[attempt]

    def step(s: Column, _: Column) -> Column:
        def row(r: int, alone: Column) -> Column:
            return F.transform(s[f"r{r}"], lambda c, j: _merged(c, alone, r, j, -1)).alias(f"r{r}")

        def take(alone: Column) -> Column:
            rest = [row(r, alone) for r in range(3)]
            mine = F.size(F.filter(alone, lambda p: p["n"] == 1))
            more = F.struct(*rest, (s["a"] + mine).alias("a"), (s["b"] + F.size(alone) - mine).alias("b"), F.lit(False).alias("stop"))
            return F.when(F.size(alone) > 0, more).otherwise(F.struct(*[s[c].alias(c) for c in ("r0", "r1", "r2", "a", "b")], F.lit(True).alias("stop")))

        pure = F.array_distinct(F.concat(*[F.filter(s[f"r{r}"], lambda c: (F.abs(c["n"]) == 1) & (c["c"] == F.hash(c["x"]))) for r in range(3)]))
        placed = F.transform(pure, lambda c: F.struct(c["x"].alias("x"), c["c"].alias("c"), c["n"].alias("n"), *[_slot(c["x"], size, h).alias(f"s{i}") for i, h in enumerate(shifts)]))
        return F.when(s["stop"], s).otherwise(let(placed, take))

    begin = lambda d: F.struct(*[d[c].alias(c) for c in ("r0", "r1", "r2")], F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(False).alias("stop"))
    empty = lambda s: F.forall(cells(s), lambda x: (x["n"] == 0) & (x["x"] == 0) & (x["c"] == 0))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), let(rows, begin), step, lambda s: F.struct(empty(s).alias("ok"), s["a"].alias("a"), s["b"].alias("b")))


def difference(a: Column, b: Column, cells_a: Column, cells_b: Column) -> Column:
    """(a, b): how many digests only array a, only array b has, by sketches; a bin that no try recovers is compared digest by digest."""

    def tried(both: Column, attempt: int) -> Column:
        if attempt == len(TRIES):
            only = lambda x, y: F.size(F.array_except(both[x], both[y]))
            return F.struct(F.lit(True).alias("ok"), only("a", "b").alias("a"), only("b", "a").alias("b"))
        found = peel(subtract(sketch(both["a"], attempt), sketch(both["b"], attempt)), attempt)
        return let(found, lambda r: F.when(r["ok"], r).otherwise(tried(both, attempt + 1)))

    def part(both: Column, shift: int, mask: Column, t: Column) -> Column:
        inside = lambda keys: F.filter(keys, lambda k: F.shiftrightunsigned(k, shift).bitwiseAND(mask) == t)
        return F.struct(inside(both["a"]).alias("a"), inside(both["b"]).alias("b"))

    zero = F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"))
    upto = lambda mask: F.sequence(F.lit(0).cast("long"), mask)

    def add(s: Column, p: Column) -> Column:
        return F.struct((s["a"] + p["a"]).alias("a"), (s["b"] + p["b"]).alias("b"))

    def group(both: Column, mask: Column) -> Column:
        """A group's bins, each tried by itself."""
        return F.aggregate(F.transform(upto(mask), lambda t: let(part(both, BIN, mask, t), lambda own: tried(own, 1))), zero, add)

    def larger() -> Column:
        """Bins by the load; groups of bins first, so that a long text's digests aren't gone through for every bin."""
        load = F.greatest(F.lit(1), F.ceil((F.size(a) + F.size(b)) / F.lit(BIN_LOAD))).cast("double")
        bits = F.least(F.lit(GROUP_BITS + 15), F.ceil(F.log2(load))).cast("int")
        high = F.least(F.lit(GROUP_BITS), F.floor(bits / 2).cast("int"))
        one = lambda n: F.pow(F.lit(2.0), n).cast("long") - 1
        masks = F.struct(one(high).alias("groups"), one(bits - high).alias("bins"), F.struct(a.alias("a"), b.alias("b")).alias("both"))
        parts = let(masks, lambda m: F.transform(upto(m["groups"]), lambda g: let(part(m["both"], GROUP, m["groups"], g), lambda own: group(own, m["bins"]))))
        return F.aggregate(parts, zero, add, lambda s: F.struct(F.lit(True).alias("ok"), s["a"].alias("a"), s["b"].alias("b")))

    return let(peel(subtract(cells_a, cells_b)), lambda r: F.when(r["ok"], r).otherwise(larger()))


def likeness(a: Column, b: Column, cells_a: Column, cells_b: Column) -> Column:
    """Shared digests, twice, over all digests of both (1 for two empty sets), from the recovered difference."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(let(difference(a, b, cells_a, cells_b), lambda d: (both - d["a"] - d["b"]) / both.cast("double")))


def as_text(all_cells: Column) -> Column:
    """A sketch as hex: per cell 6 digits of the count (modulo 16^6), 16 of the digests, 8 of the checks."""
    part = lambda c, w: F.lower(F.right(F.lpad(F.hex(c), 16, "0"), F.lit(w)))
    return F.array_join(F.transform(all_cells, lambda c: F.concat(part(c["n"].cast("long"), 6), part(c["x"], 16), part(c["c"].cast("long"), 8))), "")


def _numbers(values: list[int]) -> Column:
    """A literal array of longs, as one folded literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def with_next(df: DataFrame, key: str, columns: list[str], tie: list[str] | None = None) -> DataFrame:
    """df with `next`: a struct of columns of the row that follows by descending key (null keys last); the first follows the last.

    Rows with one key follow in the order of a hash of the columns in tie (default: all those named). Keys (integers) are cut into ranges by approximate
    quantiles; a key that several quantiles name has a range of its own, parted by that hash, and so have null keys. The
    first row of each bucket is also sent to the bucket before it, so one exchange serves. Rows alike in key and columns
    stay together.
    """
    if not isinstance(df.schema[key].dataType, IntegralType):
        raise TypeError(f"{key}: an integer column")
    low = -(1 << 63)
    n, known = df.agg(F.count("*"), F.count(key)).first()
    n_buckets = min(MOST_BUCKETS, max(1, known // BUCKET_ROWS))
    cuts = df.agg(F.percentile_approx(F.col(key).cast("long"), [i / n_buckets for i in range(1, n_buckets)], max(10_000, 4 * n_buckets))).first()[0] if n_buckets > 1 else []
    often = Counter(cuts or [])
    power = lambda rows: max(0, math.ceil(math.log2(max(1, rows))))
    bounds = sorted({*often, *(c + 1 for c, m in often.items() if m > 1 and c < -low - 1)})
    # ranges by descending key, then null: bits of the hash that part each, and the first bucket of each
    bits = [power(often[c]) if often[c] > 1 else 0 for c in reversed(bounds)] + [0, power((n - known) // max(BUCKET_ROWS, n // MOST_BUCKETS))]
    first = [0, *accumulate(1 << b for b in bits)]
    span = F.lit(0)
    if bounds:
        steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(bounds).bit_length()))])
        places = _numbers(bounds)
        below = F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= len(bounds)) & (F.get(places, at + s - 1) <= F.col("_key")), at + s).otherwise(at))
        span = F.lit(len(bounds)) - below
    own = df.withColumn("_key", F.col(key).cast("long")).withColumn("_tie", F.xxhash64(*(tie or columns)))
    own = own.withColumn("_rev", F.coalesce(F.bitwise_not("_key"), F.lit(0).cast("long"))).withColumn("_span", F.when(F.col("_key").isNull(), len(bounds) + 1).otherwise(span))
    part = F.expr("shiftright(_tie, 64 - cast(_bits AS int)) + shiftleft(1L, cast(_bits AS int) - 1)")
    own = own.withColumn("_bits", F.get(_numbers(bits), F.col("_span")))
    bucket = F.get(_numbers(first), F.col("_span")) + F.when(F.col("_bits") > 0, part).otherwise(0)
    heads = {r["b"]: r["h"] for r in own.groupBy(bucket.alias("b")).agg(F.min(F.struct("_rev", "_tie")).alias("h")).collect()}
    order = sorted(heads) or [0]
    before = {b: order[i - 1] for i, b in enumerate(order)}
    every = range(order[-1] + 1)
    head = [F.get(_numbers([heads[b][c] if b in heads else 0 for b in every]), F.col("_bucket").cast("int")) for c in (0, 1)]
    previous = F.get(_numbers([before.get(b, 0) for b in every]), F.col("_bucket").cast("int"))
    place = lambda b, copy: F.struct(b.alias("_at"), F.lit(copy).alias("_copy"))
    there = F.array(place(F.col("_bucket"), False))
    sent = own.withColumn("_bucket", bucket).withColumn("_head", (F.col("_rev") == head[0]) & (F.col("_tie") == head[1]))
    sent = sent.select(*df.columns, "_rev", "_tie", F.inline(F.when(F.col("_head"), F.concat(there, F.array(place(previous, True)))).otherwise(there)))
    follow = Window.partitionBy("_at").orderBy("_copy", "_rev", "_tie")
    return sent.withColumn("next", F.lead(F.struct(*columns)).over(follow)).filter(~F.col("_copy")).drop("_rev", "_tie", "_at", "_copy")


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next row's
    text. A null text counts as empty: its sketch is all zeros; two texts without words are alike (1). A single row is
    its own next. Repeated rows follow each other. An empty table gives none. Other columns are not read. key is an
    integer column.
    """
    own = df.select(column(key).alias("key"), text_or_empty(column(text)).alias("text")).withColumn("keys", digests(F.col("text")))
    rows = with_next(own, "key", ["text", "keys"], ["text"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select("key", n.cast("long").alias("n_chars"), "keys", F.col("next.keys").alias("next_keys"), F.concat(F.substr("text", F.lit(1), n - half), F.substr("next.text", F.lit(1), half)).alias("edited"))
    rows = rows.select("key", "n_chars", "keys", "next_keys", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("edited")).alias("edited_keys"))
    rows = rows.select("*", F.transform(F.array("keys", "next_keys", "edited_keys"), lambda k: sketch(k)).alias("sketches"))
    rows = rows.select("*", *[F.get("sketches", F.lit(i)).alias(n) for i, n in enumerate(("cells", "next_cells", "edited_cells"))])
    other = lambda k, c: F.struct(F.col(k).alias("keys"), F.col(c).alias("cells"))
    # one expression for both comparisons
    near = F.transform(F.array(other("edited_keys", "edited_cells"), other("next_keys", "next_cells")), lambda o: likeness(F.col("keys"), o["keys"], F.col("cells"), o["cells"]))
    prints = F.transform(F.array("cells", "edited_cells"), lambda c: as_text(cells(c)))
    rows = rows.select(F.col("key").alias(key), "n_chars", "edited_sha256", prints.alias("prints"), near.alias("near"))
    at = lambda c, i: F.get(c, F.lit(i))
    return rows.select(column(key), "n_chars", "edited_sha256", at("prints", 0).alias("fingerprint"), at("prints", 1).alias("edited_fingerprint"), at("near", 0).alias("near_edited"), at("near", 1).alias("near_next"))
