"""Long reads: oligo matches, signatures, completeness, digests.

Matches are rows (qname, L, oligo, start, end, score); a read's matches in read order are an array of structs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions.alignment import local_alignments
from tesserae.functions.sequence import oligo_partner, reverse_complement

MATCHES = "qname string, L int, oligo string, start int, end int, score double"


def islands(covered: list[tuple[int, int, float]], least: int) -> list[tuple[int, int, float]]:
    """Merge touching (start, end, score) hits; keep those longer than `least`; the best score counts."""
    out: list[list] = []
    for s, e, score in sorted(covered):
        if out and s <= out[-1][1]:
            out[-1][1], out[-1][2] = max(out[-1][1], e), max(out[-1][2], score)
        else:
            out.append([s, e, score])
    return [(s, e, x) for s, e, x in out if e - s > least]


def resolved(hits: list[tuple[str, int, int, float]], gap: float = 3.0, least: int = 7) -> list[tuple[str, int, int, float]]:
    """One oligo per base: in the order given, a hit takes its stretch if it beats every base's score there by more than gap."""
    if not hits:
        return []
    n = max(e for _, _, e, _ in hits)
    who, score = [None] * n, [0.0] * n
    for name, s, e, x in hits:
        if e > s and max(score[s:e]) + gap < x:
            who[s:e], score[s:e] = [name] * (e - s), [x] * (e - s)
    out, at = [], 0
    while at < n:
        end = at + 1
        while end < n and who[end] == who[at]:
            end += 1
        if who[at] is not None and end - at > least:
            out.append((who[at], at, end, max(score[at:end])))
        at = end
    return out


def oligo_matches(reads: DataFrame, oligos: dict[str, str], share: float = 0.4, gap: float = 3.0, least: int = 7, name: str = "qname", seq: str = "seq") -> DataFrame:
    """Matches of a bounded set of oligos in every read, overlaps resolved; a narrow map over Arrow batches."""

    def run(batches):
        for b in batches:
            rows = []
            for q, s in zip(b["qname"], b["seq"], strict=True):
                hits = [(o, a, e, x) for o, oligo in oligos.items() for a, e, x in islands(local_alignments(s or "", oligo, share), least)]
                rows += [(q, len(s or ""), o, a, e, x) for o, a, e, x in resolved(hits, gap, least)]
            yield pd.DataFrame(rows, columns=["qname", "L", "oligo", "start", "end", "score"])

    return reads.select(F.col(name).alias("qname"), F.col(seq).alias("seq")).mapInPandas(run, MATCHES)


def not_yet_aligned(reads: DataFrame, cache: DataFrame, name: str = "qname") -> DataFrame:
    """Reads that a cache of matches (any oligo) doesn't have."""
    return reads.join(cache.select(F.col("qname").alias("_q")).distinct(), F.col(name) == F.col("_q"), "left_anti")


def relevant_matches(matches: DataFrame, oligos: dict[str, str], share: float = 0.4, relevant: list[str] | None = None, unknown: float = 22.0) -> DataFrame:
    """Matches above 2 x length x share of their oligo (unknown ones: a fixed score), of relevant oligos and their reverses."""
    spark = matches.sparkSession
    known = spark.createDataFrame([(n, 2.0 * len(s) * share) for n, s in oligos.items()] or [("", 0.0)], "oligo string, floor double")
    out = matches.join(F.broadcast(known), "oligo", "left").filter(F.col("score") > F.coalesce("floor", F.lit(unknown))).drop("floor")
    return out if relevant is None else out.filter(F.col("oligo").isin(*relevant, *[f"{r}_RC" for r in relevant]))


def per_read(matches: DataFrame) -> DataFrame:
    """(qname, L, parts): each read's matches in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("start", "end", "oligo", "score"))), lambda p: p)
    return matches.groupBy("qname").agg(F.max("L").alias("L"), parts.alias("parts"))


def oriented(reads: DataFrame, anchor: str, seq: str | None = None) -> DataFrame:
    """Reads turned so that the anchor oligo outnumbers its reverse; ties by the first part, then by more reverse parts.

    Turned reads have their parts reversed, renamed X <-> X_RC, and their coordinates (and sequence) reverse-complemented.
    """
    names = F.transform("parts", lambda p: p["oligo"])
    count = lambda n: F.size(F.filter(names, lambda x: x == n))
    fw, rc = count(anchor), count(f"{anchor}_RC")
    back = F.size(F.filter(names, lambda x: x.endswith("_RC")))
    first_back = F.get(names, F.lit(0)).endswith("_RC")
    turn = (fw < rc) | ((fw == rc) & (first_back | (back > F.size("parts") - back)))
    turned = F.reverse(F.transform("parts", lambda p: F.struct((F.col("L") - p["end"]).alias("start"), (F.col("L") - p["start"]).alias("end"), oligo_partner(p["oligo"]).alias("oligo"), p["score"].alias("score"))))
    out = reads.withColumn("turned", F.coalesce(turn, F.lit(False)))
    if seq:
        out = out.withColumn(seq, F.when(F.col("turned"), reverse_complement(F.col(seq))).otherwise(F.col(seq)))
    return out.withColumn("parts", F.when(F.col("turned"), turned).otherwise(F.col("parts"))).withColumn("signature", F.transform("parts", lambda p: p["oligo"]))


def contracted(signature: Column, only_repeat: bool = True) -> Column:
    """The signature joined by commas with tandem repeats as X+; with only_repeat, just ?X+ of the most repeated X (first of ties)."""
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.array().cast("array<string>").alias("again"))

    def add(s: Column, x: Column) -> Column:
        last = F.try_element_at(s["parts"], F.lit(-1))
        same = F.coalesce(F.regexp_replace(last, r"\+$", "") == x, F.lit(False))
        marked = F.concat(F.slice(s["parts"], 1, F.greatest(F.size(s["parts"]) - 1, F.lit(0))), F.array(F.concat(x, F.lit("+"))))
        return F.when(same, F.struct(marked.alias("parts"), F.array_append(s["again"], x).alias("again"))).otherwise(F.struct(F.array_append(s["parts"], x).alias("parts"), s["again"].alias("again")))

    def finish(s: Column) -> Column:
        plain = F.array_join(s["parts"], ",")
        if not only_repeat:
            return plain
        ranked = F.transform(F.array_distinct(s["again"]), lambda x, i: F.struct((-F.size(F.filter(s["again"], lambda y: y == x))).alias("n"), i.alias("i"), x.alias("x")))
        return F.when(F.size(s["again"]) > 0, F.concat(F.lit("?"), F.replace(F.array_min(ranked)["x"], F.lit("_RC"), F.lit("")), F.lit("+"))).otherwise(plain)

    return F.aggregate(signature, start, add, finish)


def signature_counts(reads: DataFrame, signature: str = "signature") -> DataFrame:
    """(signature, n, concatemer, reprimed): counts; reprimed is how many of them end in the reverse of their first part."""
    s = F.col(signature)
    re_ = (F.size(s) > 1) & (oligo_partner(F.get(s, F.lit(0))) == F.element_at(s, -1))
    own = reads.filter(F.size(s) > 0).select(contracted(s).alias("signature"), F.when(re_, 1).otherwise(0).alias("r"))
    return own.groupBy("signature").agg(F.count("*").alias("n"), F.sum("r").alias("reprimed")).withColumn("concatemer", F.col("signature").contains("+"))


def concatenation_counts(counts: DataFrame) -> DataFrame:
    part = F.explode(F.split("signature", ",")).alias("part")
    return counts.select(part, "n").filter(F.col("part").endswith("+")).groupBy("part").agg(F.sum("n").alias("n"))


def repriming_counts(reads: DataFrame, signature: str = "signature") -> DataFrame:
    s = F.col(signature)
    first = F.get(s, F.lit(0))
    return reads.filter(oligo_partner(first) == F.element_at(s, -1)).groupBy(F.replace(first, F.lit("_RC"), F.lit("")).alias("part")).agg(F.count("*").alias("n"))


def matching_signature(reads: DataFrame, query: list[str], substring: bool = False, signature: str = "signature") -> DataFrame:
    """Reads whose contracted signature is (or holds) the query, with the offset in parts and its end."""
    text, q = contracted(F.col(signature)), ",".join(query)
    at = F.instr(text, q)
    before = F.substr(text, F.lit(1), F.greatest(at - 1, F.lit(0)))
    offset = F.length(before) - F.length(F.replace(before, F.lit(","), F.lit("")))
    out = reads.filter(at > 0 if substring else text == q)
    first = offset if substring else F.lit(0)
    return out.withColumn("from", first).withColumn("to", first + len(query))


def with_signatures(reads: DataFrame, include: str | None = None, exclude: str | None = None, signature: str = "signature") -> DataFrame:
    """Reads whose signature, joined by commas, holds one text and doesn't hold another."""
    text = F.array_join(signature, ",")
    for part, wanted in ((include, True), (exclude, False)):
        if part:
            reads = reads.filter(text.contains(part) if wanted else ~text.contains(part))
    return reads


def part_dimensions(reads: DataFrame) -> DataFrame:
    """Arrays starts, ends and scores of the parts from..to of matching reads."""
    some = F.slice("parts", F.col("from") + 1, F.col("to") - F.col("from"))
    return reads.select("qname", *[F.transform(some, lambda p: p).getField(c).alias(f"{c}s") for c in ("start", "end", "score")])


def first_occurrence(reads: DataFrame, oligo: str) -> DataFrame:
    hit = F.get(F.filter("parts", lambda p: p["oligo"] == oligo), F.lit(0))
    return reads.select("qname", "L", hit.alias("hit")).filter("hit IS NOT NULL").select("qname", "hit.start", "hit.end", "hit.score", "L")


def insert_bounds(reads: DataFrame, after: str, distal: int = 150) -> DataFrame:
    """cDNA bounds: the end of the last part from `after` on that starts within distal of the start; the least start of parts
    that end within distal of the end."""
    at = F.greatest(F.array_position(F.transform("parts", lambda p: p["oligo"]), after), F.lit(1)).cast("int")
    some = F.slice("parts", at, F.greatest(F.size("parts"), F.lit(1)))
    left = F.filter(some, lambda p: p["start"] <= distal)
    right = F.filter(some, lambda p: p["end"] >= F.col("L") - distal)
    start = F.coalesce(F.try_element_at(left, F.lit(-1))["end"], F.lit(0))
    end = F.least(F.col("L"), F.coalesce(F.array_min(F.transform(right, lambda p: p["start"])), F.col("L")))
    names = (F.coalesce(F.try_element_at(left, F.lit(-1))["oligo"], F.lit("")).alias("start_oligo"), F.coalesce(F.try_element_at(right, F.lit(-1))["oligo"], F.lit("")).alias("end_oligo"))
    return reads.select("*", start.alias("cdna_start"), end.alias("cdna_end"), *names)


def between(reads: DataFrame, after: str, before: str, low: int = 0, high: int = 1 << 30, least: int = 0, most: int = 1 << 30) -> DataFrame:
    """The first pair of neighbouring parts (after, before) within [low, high] whose gap has a length in bounds: gap_start, gap_end."""
    n = F.size("parts")
    pairs = F.arrays_zip(F.slice("parts", 1, F.greatest(n - 1, F.lit(0))).alias("a"), F.slice("parts", 2, F.greatest(n - 1, F.lit(0))).alias("b"))
    gap = lambda z: z["b"]["start"] - z["a"]["end"]
    ok = lambda z: (z["a"]["oligo"] == after) & (z["b"]["oligo"] == before) & (z["a"]["start"] <= high) & (z["b"]["end"] >= low) & (gap(z) >= least) & (gap(z) <= most)
    hit = F.get(F.filter(pairs, ok), F.lit(0))
    return reads.select("*", hit["a"]["end"].alias("gap_start"), hit["b"]["start"].alias("gap_end"))


def completeness(reads: DataFrame, intact: list[str], signature: str = "signature") -> DataFrame:
    """(prefix, n): reads by the longest prefix of the intact signature that their signature text holds; none: ''."""
    text = F.array_join(signature, ",")
    case = F.lit("")
    for i in range(1, len(intact) + 1):
        p = ",".join(intact[:i])
        case = F.when(text.contains(p), F.lit(p)).otherwise(case)
    return reads.groupBy(case.alias("prefix")).agg(F.count("*").alias("n"))


def completeness_contexts(reads: DataFrame, intact: list[str], signature: str = "signature") -> DataFrame:
    """(kind, context, n): what stands before and after the intact signature in reads that have it."""
    text, p = F.array_join(signature, ","), ",".join(intact)
    own = reads.filter(text.contains(p)).select(F.regexp_replace(F.substring_index(text, p, 1), ",$", "").alias("prefix"), F.regexp_replace(F.substring_index(text, p, -1), "^,", "").alias("suffix"))
    return own.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("context")) for k in ("prefix", "suffix")]))).groupBy("kind", "context").agg(F.count("*").alias("n"))


def core_signature(complete: str, prefixes: list[str] = ("P5",), suffixes: list[str] = ("N70X",)) -> list[str]:
    parts = complete.split(",")
    while parts and parts[0] in prefixes:
        parts = parts[1:]
    while parts and parts[-1] in suffixes:
        parts = parts[:-1]
    return parts


def found_parts(signature: Column, core: list[str]) -> Column:
    """Parts of the core that a signature (an array) has in core order, from the core's first part on; repeats stay in place."""
    every = F.array(*map(F.lit, core))
    at = F.greatest(F.array_position(signature, core[0]), F.lit(1)).cast("int")
    rest = F.slice(signature, at, F.greatest(F.size(signature), F.lit(1)))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("found"))

    def add(s: Column, x: Column) -> Column:
        i = F.array_position(every, x)
        return F.when((i > 0) & (i >= s["at"]), F.struct(i.alias("at"), F.array_append(s["found"], x).alias("found"))).otherwise(s)

    found = F.aggregate(rest, start, add, lambda s: s["found"])
    return F.filter(every, lambda c: F.array_contains(found, c))


def part_class(found: Column, core: list[str]) -> Column:
    """complete, missing_... (fewer missing than found) or only_..."""
    every = F.array(*map(F.lit, core))
    missing = F.array_sort(F.array_except(every, found))
    return F.when(F.size(missing) == 0, "complete").when(F.size(missing) < F.size(found), F.concat(F.lit("missing_"), F.array_join(missing, ","))).otherwise(F.concat(F.lit("only_"), F.array_join(F.array_sort(found), ",")))


def digest(counts: DataFrame, complete: str, related: str = "bead_start", prefixes: list[str] = ("P5",), suffixes: list[str] = ("N70X",)) -> DataFrame:
    """(kind, name, n) from (signature, n): bead classes, other signatures with a 'bead-related' total, and parts found up to each."""
    core = core_signature(complete, prefixes, suffixes)
    own = counts.withColumn("_p", F.split("signature", ",")).withColumn("_r", F.array_contains("_p", related)).withColumn("_f", found_parts(F.col("_p"), core))
    row = lambda k, name: F.struct(F.lit(k).alias("kind"), name.alias("name"))
    upto = F.transform(F.sequence(F.lit(1), F.greatest(F.size("_f"), F.lit(1))), lambda i: row("found", F.array_join(F.slice("_f", F.lit(1), i), ",")))
    near = F.concat(F.array(row("bead", part_class(F.col("_f"), core)), row("other", F.lit("bead-related"))), F.when(F.size("_f") > 0, upto).otherwise(F.slice(upto, 1, 0)))
    return own.select("n", F.inline(F.when(F.col("_r"), near).otherwise(F.array(row("other", F.col("signature")))))).groupBy("kind", "name").agg(F.sum("n").alias("n"))


def synthesis_rates(found: DataFrame, total: int | None = None) -> DataFrame:
    """found (name: comma-joined prefix, n) with rate = n over the n of the prefix one part shorter (the first: over total, or 1)."""
    size = F.size(F.split("name", ","))
    before = F.lag("n").over(Window.partitionBy().orderBy("parts"))
    own = found.withColumn("parts", size)
    return own.withColumn("rate", F.coalesce(F.try_divide(F.col("n").cast("double"), F.coalesce(before, F.lit(total) if total else F.col("n"))), F.lit(0.0)))


def part_histograms(reads: DataFrame, signature: str = "signature") -> DataFrame:
    """(signature, oligo, attr, value, freq): start, end, length and score of every part."""
    p = F.col("p")
    attrs = F.array(*[F.struct(F.lit(n).alias("attr"), v.cast("double").alias("value")) for n, v in (("start", p["start"]), ("end", p["end"]), ("len", p["end"] - p["start"]), ("score", p["score"]))])
    own = reads.select(contracted(F.col(signature)).alias("signature"), "parts").select("signature", F.explode("parts").alias("p"))
    return own.select("signature", p["oligo"].alias("oligo"), F.inline(attrs)).groupBy("signature", "oligo", "attr", "value").agg(F.count("*").alias("freq"))


def edit_profile(matches: DataFrame, oligo: str, seq: str = "match_seq") -> DataFrame:
    """(position, kind, edit, n): matches and edits per oligo position over matched stretches of reads, by global alignment.

    edit is oligo base + read base, '-' for a gap.
    """

    def run(batches):
        for b in batches:
            rows = []
            for s in b[seq]:
                rows += _edits(oligo, s or "")
            yield pd.DataFrame(rows, columns=["position", "kind", "edit"])

    return matches.select(seq).mapInPandas(run, "position int, kind string, edit string").groupBy("position", "kind", "edit").agg(F.count("*").alias("n"))


def _edits(oligo: str, read: str) -> list[tuple[int, str, str]]:
    n, m = len(oligo), len(read)
    cost = [[i if j == 0 else 0 for j in range(m + 1)] for i in range(n + 1)]  # read ends are free
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + (oligo[i - 1] != read[j - 1]), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    j, i, out = min(range(m + 1), key=lambda k: (cost[n][k], k)), n, []
    while i > 0:
        if j > 0 and cost[i][j] == cost[i - 1][j - 1] + (oligo[i - 1] != read[j - 1]):
            same = oligo[i - 1] == read[j - 1]
            out.append((i - 1, "match" if same else "edit", oligo[i - 1] + read[j - 1]))
            i, j = i - 1, j - 1
        elif cost[i][j] == cost[i - 1][j] + 1:
            out.append((i - 1, "edit", f"{oligo[i - 1]}-"))
            i -= 1
        else:
            out.append((i, "edit", f"-{read[j - 1]}"))
            j -= 1
    return out[::-1]


def examples(reads: DataFrame, seq: str = "seq", n: int = 11, key: str = "qname") -> DataFrame:
    """Up to n reads per signature with a line of their parts: name[start-end]."""
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["oligo"], F.lit("["), p["start"].cast("string"), F.lit("-"), p["end"].cast("string"), F.lit("]"))), " ")
    own = reads.select(key, contracted(F.col("signature")).alias("signature"), text.alias("annotation"), seq)
    return own.withColumn("_n", F.row_number().over(Window.partitionBy("signature").orderBy(key))).filter(F.col("_n") <= n).drop("_n")


def sample_order(samples: DataFrame, name: str = "sample", priority: str = "prio") -> DataFrame:
    return samples.orderBy(F.asc_nulls_last(priority), name)
