"""BAM files without a native library: BGZF members inflated and records decoded in Arrow batches.

A file is read in blocks by Spark's text source, whose lines end where a BGZF member names its size, so any file system works.
A first pass counts each block's records. If every block of a file ends where a record does (as `write_bam` and the usual
writers see to), each begins with one, and tasks decode blocks; other files are one task each, one row of the binaryFile
source (2 GB at most), inflated member by member.
"""

from __future__ import annotations

import binascii
import itertools
import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASES, OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
SCHEMA = "file string, record_no long, qname string, flag int, rname string, pos int, mapq int, cigar string, seq string, qual string, tags map<string,string>"
NAMES = ["file", "record_no", "qname", "flag", "rname", "pos", "mapq", "cigar", "seq", "qual", "tags"]
#: Bytes to bytes: letters to hexadecimal digits of their codes and back, qualities to text and back; entries of a cache at most.
TO_HEX = bytes(b"0123456789abcdef"[BASES.find(chr(c).upper()) if chr(c).upper() in BASES else 15] for c in range(256))
FROM_HEX = bytes(BASES.encode()[int(chr(c), 16)] if chr(c) in "0123456789abcdef" else 0 for c in range(256))
UP, DOWN = bytes((c + 33) % 256 for c in range(256)), bytes((c - 33) % 256 for c in range(256))
CACHE = 1 << 16
SIZES = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def inflated(data: bytes) -> Iterator[bytes]:
    """The contents of a file's gzip members, one after the other; the data is never copied as a whole.

    A BGZF member says how long it is (the BC field of its header); other members are inflated piece by piece.
    """
    view, at = memoryview(data), 0
    while at < len(view):
        size = member_size(view, at)
        if size:
            yield zlib.decompress(view[at : at + size], 31)
            at += size
            continue
        d = zlib.decompressobj(31)
        while not d.eof and at < len(view):
            piece = view[at : at + (1 << 16)]
            out = d.decompress(piece)
            at += len(piece) - len(d.unused_data)
            if out:
                yield out


def member_size(view: memoryview, at: int) -> int:
    """Bytes of the BGZF member at a place; 0 if it doesn't say."""
    if len(view) < at + 18 or view[at + 3] != 4:
        return 0
    end, p = at + 12 + int.from_bytes(view[at + 10 : at + 12], "little"), at + 12
    while p + 4 <= end:
        length = int.from_bytes(view[p + 2 : p + 4], "little")
        if bytes(view[p : p + 2]) == b"BC" and length == 2:
            return int.from_bytes(view[p + 4 : p + 6], "little") + 1
        p += 4 + length
    return 0


class Pieces:
    """A stream over pieces of bytes of which only what is asked for is held."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.at = pieces, b"", 0

    def read(self, n: int) -> bytes:
        """The next n bytes; fewer at the end."""
        have = len(self.held) - self.at
        if have < n:
            parts = [self.held[self.at :]]
            for p in self.pieces:
                parts.append(p)
                have += len(p)
                if have >= n:
                    break
            self.held, self.at = b"".join(parts), 0
        out = self.held[self.at : self.at + n]
        self.at += len(out)
        return out


def _tags(raw: bytes) -> tuple[list[str], list[str]]:
    """Names and values."""
    out, at = [], 0
    while at + 3 <= len(raw):
        name, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(b"\0", at)
            out.append((name, raw[at:end].decode()))
            at = end + 1
        elif kind == "A":
            out.append((name, chr(raw[at])))
            at += 1
        elif kind == "B":
            sub = SIZES[chr(raw[at])]
            n = struct.unpack_from("<I", raw, at + 1)[0]
            v = struct.unpack_from(f"<{n}{sub}", raw, at + 5)
            out.append((name, ",".join(map(str, v))))
            at += 5 + struct.calcsize(f"<{n}{sub}")
        else:
            v = struct.unpack_from(f"<{SIZES[kind]}", raw, at)[0]
            out.append((name, f"{v:g}" if kind == "f" else str(v)))
            at += struct.calcsize(SIZES[kind])
    return [k for k, _ in out], [v for _, v in out]


def cached(f: Callable, cache: dict, key):
    """f(key), looked up in a bounded cache."""
    out = cache.get(key)
    if out is None:
        if len(cache) >= CACHE:
            cache.clear()
        out = cache[key] = f(key)
    return out


def head_of(src: Pieces) -> list[str]:
    """The references' names; src then stands at the first record."""
    number = lambda: struct.unpack("<i", src.read(4))[0]
    if src.read(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    src.read(number())
    names = []
    for _ in range(number()):
        names.append(src.read(number())[:-1].decode())
        src.read(4)
    return names


def cigar_text(raw: bytes) -> str:
    return "".join(f"{op >> 4}{OPS[op & 15]}" for (op,) in struct.iter_unpack("<I", raw)) or "*"


def record_batches(src: Pieces, names: list[str], path: str, first: int = 0, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """SCHEMA's columns of every record from src's place on; text columns are made of bytes."""
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]
    refs, cigars, tags = [*names, "*"], {}, {}
    while True:
        own, ends, keys, values = [], [0], [], []
        while len(own) < rows and len(head := src.read(4)) == 4:
            raw = src.read(struct.unpack("<i", head)[0])
            ref, pos, l_name, mapq, _, n_ops, flag, l_seq = struct.unpack_from("<iiBBHHHi", raw)
            p = 32 + l_name
            c = p + 4 * n_ops
            q = c + (l_seq + 1) // 2
            qual = raw[q : q + l_seq]
            k, v = cached(_tags, tags, raw[q + l_seq :])
            keys += k
            values += v
            ends.append(len(keys))
            own.append((raw[32 : p - 1], flag, refs[ref] if ref >= 0 else "*", pos + 1, mapq, cached(cigar_text, cigars, raw[p:c]), binascii.hexlify(raw[c:q]).translate(FROM_HEX)[:l_seq] or b"*", b"*" if not qual or qual[0] == 255 else qual.translate(UP)))
        if not own:
            return
        n = len(own)
        columns = [pa.array(x, t) for x, t in zip(zip(*own, strict=True), kinds, strict=True)]
        tag_map = pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string()))
        file, number = pa.repeat(pa.scalar(path, pa.string()), n), pa.array(range(first, first + n), pa.int64())
        yield pa.RecordBatch.from_arrays([file, number, *columns, tag_map], names=NAMES)
        first += n


#: The empty member that ends a BGZF file (fixed value); bytes of records in a member, at most.
END_OF_FILE = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
MEMBER = 0xFF00


def member(raw: bytes) -> bytes:
    """One BGZF member."""
    d = zlib.compressobj(3, zlib.DEFLATED, -15)
    body = d.compress(raw) + d.flush()
    return struct.pack("<BBBBIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(raw), len(raw))


def tag_bytes(tag: tuple[str, str]) -> bytes:
    k, v = tag
    return k.encode() + (b"i" + struct.pack("<i", int(v)) if re.fullmatch(r"-?\d{1,9}", v) else b"Z" + v.encode() + b"\0")


def cigar_bytes(cigar: str) -> bytes:
    return b"".join(struct.pack("<I", int(n) << 4 | OPS.index(o)) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar))


def score_bytes(qual: str) -> bytes:
    if qual.isascii() and qual.isprintable() and " " not in qual:
        return qual.encode().translate(DOWN)
    return bytes(ord(c) - 33 for c in qual)


def encoded(qname: str, flag: int, ref: int, pos: int, mapq: int, cigar: str, seq: str, qual: str, tags: Iterable[tuple[str, str]], caches: tuple[dict, dict] = ({}, {})) -> bytes:  # noqa: B006  bounded
    """A record's bytes; tags are written as text, whole numbers as such."""
    letters = b"" if seq in (None, "*") else seq.encode("ascii", "replace").translate(TO_HEX)
    ops = b"" if cigar in (None, "*") else cached(cigar_bytes, caches[0], cigar)
    scores = b"\xff" * len(letters) if qual in (None, "*") else score_bytes(qual)
    own = b"".join([cached(tag_bytes, caches[1], t) for t in sorted(tags)])
    name = qname.encode() + b"\0"
    body = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name), mapq, 4680, len(ops) // 4, flag, len(letters), -1, -1, 0) + name + ops + binascii.unhexlify(letters + b"0" if len(letters) % 2 else letters) + scores + own
    return struct.pack("<i", len(body)) + body


def listed(column: pa.Array) -> list:
    """Values as Python's own, made by the column instead of one by one."""
    return column.to_numpy(zero_copy_only=False).tolist()


def write_bam(df: DataFrame, path: str, references: dict[str, int] | None = None, header: str = "@HD\tVN:1.6\n") -> None:
    """One BAM file of df's records (qname, flag, rname, pos, mapq, cigar, seq, qual, tags), partition after partition.

    Records are encoded and compressed in the tasks, all of them before the first is written; the driver only appends their
    members, batch by batch, to the file, which Spark's own file system opens.
    """
    refs = dict(references or {})
    at = {n: i for i, n in enumerate(refs)}

    pieces = lambda raw: [member(bytes(raw[i : i + MEMBER])) for i in range(0, len(raw), MEMBER)]

    def run(batches):
        for b in batches:
            raw, out = bytearray(), []
            *fixed, maps = b.columns
            start, pairs = maps.offsets.to_pylist(), list(zip(listed(maps.keys), listed(maps.items), strict=True))
            for i, (qname, flag, rname, pos, mapq, cigar, seq, qual) in enumerate(zip(*map(listed, fixed), strict=True)):
                r = encoded(qname, flag, at.get(rname, -1), pos, mapq, cigar, seq, qual, pairs[start[i] : start[i + 1]])
                if raw and len(raw) + len(r) > MEMBER:  # members begin with a record, unless one is larger than a member
                    out += pieces(raw)
                    raw = bytearray()
                raw += r
            out += pieces(raw)
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], names=["members"])

    names = ["qname", "flag", "rname", "pos", "mapq", "cigar", "seq", "qual", "tags"]
    text = (header + "".join(f"@SQ\tSN:{n}\tLN:{size}\n" for n, size in refs.items() if f"SN:{n}\t" not in header)).encode()
    head = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(refs)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in refs.items())
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    made = df.select(*names).mapInArrow(run, "members binary").persist(StorageLevel.DISK_ONLY)
    made.count()  # in all tasks at once: an iterator runs partition after partition
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        for i in range(0, len(head), MEMBER):
            out.write(bytearray(member(head[i : i + MEMBER])))
        for r in made.toLocalIterator(prefetchPartitions=True):
            out.write(bytearray(r["members"]))
        out.write(bytearray(END_OF_FILE))
    finally:
        out.close()
        made.unpersist()


#: What every BGZF member has behind its first ten bytes, before its size (fixed values).
MARK, BEFORE = "\x06\0BC\x02\0", 10


class Unaligned(ValueError):
    """A block that can't be decoded by itself."""


def block_members(block: int, values: Iterable[bytes], size: list[int]) -> Iterator[bytes]:
    """Contents of the members of a block from what lies between marks; size[0] gets the members' bytes in the file.

    Every piece has to be as long as its member says, so a mark by chance inside one is noticed.
    """
    for i, v in enumerate(values):
        if block == 0 and i == 0:
            if len(v) != BEFORE:
                raise Unaligned
            continue
        n = int.from_bytes(v[:2], "little") + 1  # v begins 16 bytes into the member, and ends 10 into the next if there is one
        if n < 26 or len(v) not in (n - 16, n - 16 + BEFORE):
            raise Unaligned
        try:
            out = zlib.decompress(v[2 : n - 24], -15)
        except zlib.error as e:
            raise Unaligned from e
        if zlib.crc32(out) != int.from_bytes(v[n - 24 : n - 20], "little"):
            raise Unaligned
        size[0] += n
        yield out


def by_block(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[bytes]]]:
    rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns], strict=True))
    for key, own in itertools.groupby(rows, lambda r: r[:2]):
        yield key, (r[2] for r in own)


def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, n records, size in the file, names: in a file's first block) of blocks; n is -1 if one doesn't hold whole records."""
    for (file, block), values in by_block(batches):
        n, size, names = 0, [0], None
        src = Pieces(block_members(block, values, size))
        try:
            if block == 0:
                names = head_of(src)
            while len(head := src.read(4)) == 4:
                length = struct.unpack("<i", head)[0]
                if length < 32 or len(src.read(length)) < length:
                    raise Unaligned
                n += 1
            if head:
                raise Unaligned
        except (ValueError, struct.error):  # not BGZF, or a header or record that goes on in the next block
            n = -1
        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block], pa.int64()), pa.array([n], pa.int64()), pa.array(size, pa.int64()), pa.array([names], pa.list_(pa.string()))], names=["file", "block", "n", "size", "names"])


def read_bam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Records of BAM files in file order; tags as text."""
    every = paths if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").load(every)
    listed = {r[0]: (r[1], r[2]) for r in files.select(F.col("_metadata.file_path"), "path", "length").collect()}
    pieces = lambda these: spark.read.option("lineSep", MARK).text(these).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    blocks: dict[str, list] = {}
    plain = [path for path, _ in listed.values() if not path.endswith((".gz", ".bgz"))]
    for r in pieces(plain).mapInArrow(counted, "file string, block long, n long, size long, names array<string>").collect() if plain else []:
        blocks.setdefault(r["file"], []).append(r)
    begin: dict[tuple[str, int], int] = {}
    names: dict[str, list[str]] = {}
    for f, own in blocks.items():
        own.sort(key=lambda r: r["block"])
        if f in listed and own[0]["names"] is not None and all(r["n"] >= 0 for r in own) and sum(r["size"] for r in own) == listed[f][1]:
            names[f], at = own[0]["names"], 0
            for r in own:
                begin[f, r["block"]] = at
                at += r["n"]
    path_of = {f: listed[f][0] for f in names}

    def run_blocks(batches):
        for (file, block), values in by_block(batches):
            src = Pieces(block_members(block, values, [0]))
            if block == 0:
                head_of(src)
            yield from record_batches(src, names[file], path_of[file], begin[file, block])

    def run_files(batches):
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                src = Pieces(inflated(data.as_py()))
                yield from record_batches(src, head_of(src), path)

    rest = [path for f, (path, _) in listed.items() if f not in names]
    parts = [pieces(list(path_of.values())).mapInArrow(run_blocks, SCHEMA)] if names else []
    if rest or not parts:
        parts.append((spark.read.format("binaryFile").load(rest) if rest else files).select("path", "content").mapInArrow(run_files, SCHEMA))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
