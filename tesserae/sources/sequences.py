"""FASTQ, FASTA and SAM text; sinks for unaligned records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.operators.reads import paired, single
from tesserae.sources.lines import numbered_lines


def read_fastq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(pair: the file, record_no, name, seq, qual): four lines to a record; lines of a task are merged before the shuffle."""
    lines = numbered_lines(spark, paths).withColumn("k", F.col("line_no") % 4)
    part = lambda k: F.max(F.when(F.col("k") == k, F.col("value")))
    rec = lines.groupBy(F.col("file").alias("pair"), F.floor(F.col("line_no") / 4).alias("record_no"))
    return rec.agg(F.regexp_replace(part(0), "^@", "").alias("name"), part(1).alias("seq"), part(3).alias("qual")).filter("seq IS NOT NULL")


def read_any(spark: SparkSession, paths: str | list[str], skim: int = 0) -> DataFrame:
    """(pair, record_no, name, seq, qual) of read files by their extension, BAM or FASTQ (gzip included); globs are allowed.

    skim: only every n-th record of a file, from its first.
    """
    from tesserae.sources.bam import read_bam

    every = [paths] if isinstance(paths, str) else list(paths)
    bams, fastqs = [p for p in every if p.endswith(".bam")], [p for p in every if not p.endswith(".bam")]
    parts = [read_fastq(spark, fastqs)] if fastqs else []
    if bams:
        parts.append(read_bam(spark, bams).select(F.col("file").alias("pair"), "record_no", F.col("qname").alias("name"), "seq", "qual"))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.filter(F.col("record_no") % skim == 0) if skim > 1 else rows


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The data files that a path (a file, a folder or a glob) stands for, in order, as URIs."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for status in fs.globStatus(p) or []:
        for s in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
            if s.isFile() and not s.getPath().getName().startswith(("_", ".")):
                out.append(s.getPath().toUri().toString())
    if not out:
        raise FileNotFoundError(path)
    return sorted(out)


def _one_slash(uri: Column) -> Column:
    """URIs of one file alike, however many slashes their scheme has."""
    return F.regexp_replace(uri, "^([A-Za-z0-9]+):/+(?=[^/])", "$1:/")


def read_reads(spark: SparkSession, r2: list[str], r1: list[str | None] | None = None, cells: list[str] | None = None) -> DataFrame:
    """Reads of all file pairs, numbered by pair and record; without R1 as single-end reads. cells: a name for each pair.

    All R2 files are one scan and all R1 files another, however many pairs there are; folders pair file by file.
    """
    pairs = []
    for i, path in enumerate(r2):
        other = r1[i] if r1 and i < len(r1) else None
        seconds = files_of(spark, path)
        firsts = files_of(spark, other) if other else [None] * len(seconds)
        if len(firsts) != len(seconds):
            raise ValueError(f"{len(firsts)} files of R1, {len(seconds)} of R2: {other}, {path}")
        pairs += [(a, b, cells[i] if cells else None) for a, b in zip(firsts, seconds, strict=True)]
    rows = [(n, a, b, c) for n, (a, b, c) in enumerate(pairs)]
    listed = spark.createDataFrame(rows, "n int, r1 string, r2 string, cell string").withColumns({c: _one_slash(F.col(c)) for c in ("r1", "r2")})

    def scan(side: str, paths: list[str]) -> DataFrame:
        to = listed.filter(F.col(side).isNotNull()).select(F.col(side).alias("uri"), "n", F.col("r1").isNotNull().alias("has"), "cell")
        return read_fastq(spark, paths).withColumn("uri", _one_slash(F.col("pair"))).join(F.broadcast(to), "uri").withColumn("pair", F.col("n"))  # a row per file

    second = scan("r2", [b for _, b, _ in pairs])
    parts = []
    if any(a is None for a, _, _ in pairs):
        parts.append(single(second.filter(~F.col("has"))))
    if any(a is not None for a, _, _ in pairs):
        parts.append(paired(scan("r1", [a for a, _, _ in pairs if a]), second.filter("has")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if cells is None:
        return out
    return out.join(F.broadcast(listed.select(F.col("n").alias("pair"), "cell")), "pair")


def read_sample_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Reads of all rows of a CSV with columns R2, R1 (may lack) and cell (may lack: the row number)."""
    rows = [r.asDict() for r in spark.read.csv(path, header=True).collect()]
    return read_reads(spark, [r["R2"] for r in rows], [r.get("R1") for r in rows], [r.get("cell") or str(i) for i, r in enumerate(rows)])


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, name, seq): lines of a record fused; lines that start with # are left out.

    Records are numbered within a block of a file, from what the blocks before it hold.
    """
    lines = numbered_lines(spark, paths, blocks_too=True).filter(~F.col("value").startswith("#")).withColumn("head", F.col("value").startswith(">").cast("int"))
    heads = lines.groupBy("file", "block").agg(F.sum("head").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    w = Window.partitionBy("file", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rec = lines.withColumn("own", F.sum("head").over(w)).join(heads.select("file", "block", F.coalesce(before, F.lit(0)).alias("before")), ["file", "block"])
    rec = rec.withColumn("rec", F.col("own") + F.col("before")).filter("rec > 0")
    head = F.max(F.when(F.col("value").startswith(">"), F.substring("value", 2, 1 << 30)))
    body = F.array_sort(F.collect_list(F.when(~F.col("value").startswith(">"), F.struct("line_no", F.trim("value").alias("s")))))
    return rec.groupBy("file", "rec").agg(head.alias("name"), body.alias("b")).select("file", "name", F.array_join(F.transform("b", lambda x: x["s"]), "").alias("seq"))


SAM_FIELDS = (("qname", "string"), ("flag", "int"), ("rname", "string"), ("pos", "int"), ("mapq", "int"), ("cigar", "string"), ("rnext", "string"), ("pnext", "int"), ("tlen", "int"), ("seq", "string"), ("qual", "string"))


def parse_sam(lines: Column) -> list[Column]:
    """Columns of a SAM line, tags as a map of text by tag name."""
    f = F.split(lines, "\t")
    fixed = [F.get(f, F.lit(i)).cast(t).alias(n) for i, (n, t) in enumerate(SAM_FIELDS)]
    tags = F.transform(F.slice(f, 12, 1 << 20), lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.substring(t, 6, 1 << 30).alias("v")))
    return [*fixed, F.map_from_entries(tags).alias("tags")]


def read_sam(spark: SparkSession, paths: str | list[str], hot: tuple[str, ...] = ("CB", "MI", "gn", "gf", "gs", "NH", "XF")) -> DataFrame:
    """Alignments of SAM text; hot tags become columns too (gene lists as arrays, NH as a number)."""
    rows = spark.read.text(paths).filter(~F.col("value").startswith("@")).select(*parse_sam(F.col("value")))
    for t in hot:
        v = F.col("tags")[t]
        rows = rows.withColumn(t, F.split(v, ",") if t in ("gn", "gf", "gs") else v.cast("int") if t == "NH" else v)
    return rows


def read_sam_header(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(kind, fields) of @ lines."""
    f = F.split("value", "\t")
    rows = spark.read.text(paths).filter(F.col("value").rlike("^@[A-Z]{2}(\t|$)"))
    pairs = F.transform(F.slice(f, 2, 1 << 20), lambda x: F.struct(F.substring(x, 1, 2).alias("k"), F.substring(x, 4, 1 << 30).alias("v")))
    kind = F.substring(F.get(f, F.lit(0)), 2, 2)
    return rows.select(kind.alias("kind"), F.when(kind != "CO", F.map_from_entries(pairs)).alias("fields"), "value")


def render_sam(df: DataFrame, flag: int = 4, group: str = "A", tags: tuple[str, ...] = ("CB", "MI")) -> DataFrame:
    """Unaligned SAM lines (value): name, r2, q2, tags as text lists, and a read group."""
    lists = {"A5": "a5", "T5": "t5", "A3": "a3", "T3": "t3"}
    own = [F.when(F.col(t).isNotNull(), F.concat(F.lit(f"{t}:Z:"), F.col(t))) for t in tags if t in df.columns]
    own += [F.when(F.size(c) > 0, F.concat(F.lit(f"{t}:Z:"), F.array_join(F.col(c).cast("array<string>"), ","))) for t, c in lists.items() if c in df.columns]
    fixed = F.concat_ws("\t", "qname", F.lit(str(flag)), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"), F.lit("0"), F.lit("0"), "r2", "q2")
    return df.select(F.concat_ws("\t", fixed, *own, F.lit(f"RG:Z:{group}")).alias("value"))


def read_triples(spark: SparkSession, path: str, tag: str | None = None, skip: int = 0, column: int = 0, separator: str = "\t") -> DataFrame:
    """(name, seq) from a file by its extension: text tables by column, SAM (or a tag of it), else FASTQ."""
    base = path.removesuffix(".gz")
    if base.endswith((".txt", ".csv", ".tsv")):
        return read_column(spark, path, column, skip, separator)
    if base.endswith(".sam"):
        rows = read_sam(spark, path)
        return rows.select(F.col("qname").alias("name"), (F.col("tags")[tag] if tag else F.col("seq")).alias("seq"))
    return read_fastq(spark, path).select("name", "seq")


def read_column(spark: SparkSession, path: str, column: int = 0, skip: int = 0, separator: str = "\t", file_too: bool = False) -> DataFrame:
    """(name: the line's number, seq: one column of a text table), from line `skip` on.

    Lines are numbered by file: in a folder of several, file and name together (file_too) tell lines apart.
    """
    lines = numbered_lines(spark, path).filter(F.col("line_no") >= skip) if skip else numbered_lines(spark, path)
    own = lines.select(*(["file"] if file_too else []), F.col("line_no").cast("string").alias("name"), F.get(F.split("value", f"\\Q{separator}\\E"), F.lit(column)).alias("seq"))
    return own.filter("seq IS NOT NULL")
