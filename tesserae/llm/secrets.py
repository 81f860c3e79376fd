"""Secret scans: fixed patterns, and dictionary-primed zstandard novelty for what they miss.

A candidate is a token-like string close behind a sensitive word. Its novelty is its marginal compressed size: the bits
that zstandard, primed with an identifier dictionary and the text around, spends on it beyond what it spends on the same
window without it, over the bits that its alphabet needs. Names, paths and words compress well there; key material does not.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import column, map_texts, worker_state

#: The base patterns (fixed values); ASCII letters of `assign` match in either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
HINT = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)

#: What makes a neighbourhood sensitive, beyond the words of the base patterns (fixed values).
CONTEXT = re.compile(r"(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|authorization|bearer|client[_-]?id|session[_-]?id|signature|-----BEGIN [A-Z ]*PRIVATE KEY-----)", re.IGNORECASE | re.ASCII)
#: Strings that are measured; what parts a name in them.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}(?:\.[A-Za-z0-9+/_=-]{8,})*", re.ASCII)
PARTS = re.compile(r"[+/_=.-]+")
#: Code points behind a sensitive word within which a candidate starts; text around that primes the compressor.
REACH, AROUND = 64, 400
#: Least marginal bits of a novel string, as a share of what its alphabet needs; and that of letters alone, where joined words come close.
NOVEL, NOVEL_LETTERS = 1.1, 1.3
#: Words next to sensitive ones, over all documents, that prime comparisons too: the most frequent ones, so many.
LEARNED = 400

#: Words of code that prime every comparison (fixed values; no result hangs on a single one).
IDENTIFIERS = (
    "localhost content-type application/json https://www.example.com/index.html /usr/local/bin/python /var/log/ abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 AAAAAAAAAAAAAAAA "
    "xxxxxxxxxxxxxxxx 0000000000000000 ================ ---------------- ________________ getElementById addEventListener toString valueOf hashCode your_token_here your-api-key change_me "
)
CODE_WORDS = """
access account action active address admin agent alias amount android api app application archive argument array asset async attribute audit auth author authentication authorization auto backend backup balance
base batch binary block body boolean branch bucket buffer build builder button byte cache callback cert certificate change channel character check child class client cloud cluster code collection color column
command comment commit common company component config configuration connection console container content context controller cookie copy core count country create created credential current custom customer data
database date day debug default delete deploy description detail dev device dir directory disable display document domain download draft driver edit element email enable encoding encryption endpoint engine
entity entry environment error event example exception execute export expression external factory feature field file filter first flag folder format frame framework function gateway generate generic get global
grant graph group handler hash header health height hidden history home host http icon identifier image impl import index info init input insert instance integer interface internal invalid item java job json
key label language last layer layout legacy length level library license limit line link list listener load local location lock log logger login machine main manager map master max member memory menu message
metadata method metric min mobile mode model module monitor month name namespace native network new node notification null number object offset open operation option order organization output owner package page
param parameter parent parse partition password path pattern payload payment permission phone platform plugin point policy pool port position post prefix preview primary principal priority private process
processor product production profile program project property protocol provider proxy public query queue random range rate read record redirect reference refresh region register release remote remove render
report repository request required reset resource response rest result retry role root route router rule runtime sample schedule schema scope screen script search secondary secret section secure security select
sender sequence serial server service session set setting share signature single size socket sort source space stack staging start state static status storage store stream string style subject submit subscription
success summary support switch sync system table tag target task team template tenant test text theme thread time timeout timestamp title token tool total trace track transaction transform trigger type unit update
upload url user username util validate validation value variable vendor verify version view virtual volume wait warning web webhook widget width window worker workflow workspace write year zone
"""


def primer(learned: list[str] = ()) -> bytes:
    """The dictionary of a compressor: code words, small and capital, and those of the corpus, the most frequent last (nearest)."""
    words = CODE_WORDS.split()
    return " ".join([IDENTIFIERS, *words, *(w.capitalize() for w in words), *reversed(learned)]).encode()


def alphabet(own: str) -> int:
    """How many characters the kinds of characters in a string choose from."""
    if HEXADECIMAL.fullmatch(own):
        return 10 if own.isdigit() else 16
    return sum(n for p, n in KINDS if p.search(own))


HEXADECIMAL = re.compile(r"[0-9a-f]+|[0-9A-F]+")
KINDS = ((re.compile("[0-9]"), 10), (re.compile("[a-z]"), 26), (re.compile("[A-Z]"), 26), (re.compile("[^0-9A-Za-z]"), 2))


def measurable(own: str) -> bool:
    """Whether a string may be a key at all: digits alone, or a part of 8 characters or more of several kinds, and 8 (of digits 5) different ones.

    Letters of one case aren't measured: long words need as many bits as random letters.
    """
    if own.isdigit():
        return len(set(own)) >= 5
    return len(set(own)) >= 8 and any(len(p) >= 8 and sum(bool(k.search(p)) for k, _ in KINDS) > 1 for p in PARTS.split(own))


class Novelty:
    def __init__(self, dictionary: bytes | None = None):
        primed = zstandard.ZstdCompressionDict(primer() if dictionary is None else dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=12, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)

    def marginal(self, text: str, start: int, end: int) -> float:
        """Compressed bytes per character that text[start:end] adds to the text around it."""
        around = (text[max(0, start - AROUND) : start] + text[end : end + AROUND]).encode()
        own = text[start:end].encode()
        return (len(self.compressor.compress(around + b"\n" + own)) - len(self.compressor.compress(around + b"\n"))) / len(own)

    def share(self, text: str, start: int, end: int) -> float:
        """The marginal bits per character over those that a random string of the same alphabet has."""
        return 8 * self.marginal(text, start, end) / math.log2(max(2, alphabet(text[start:end])))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns by start, then in the order assign, access, hex; code points, end exclusive."""
    found = []
    if HINT.search(text):
        found += [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text)]
    return [(s, e, kind) for s, _, e, kind in sorted(found)]


def novel_spans(text: str, base: list[tuple[int, int, str]], novelty: Novelty, threshold: float = NOVEL, letters: float = NOVEL_LETTERS) -> list[tuple[int, int, str]]:
    """Incompressible strings in sensitive context that no base span touches; every sensitive word of the text counts."""
    found, last, seen = [], -1, set()
    starts = [s for s, _, _ in base]
    ends = list(accumulate((e for _, e, _ in base), max))
    for c in CONTEXT.finditer(text):
        for m in CANDIDATE.finditer(text, c.end(), min(len(text), c.end() + REACH + 16)):
            s = m.start()
            if s > c.end() + REACH:
                break
            if s in seen or s < last:
                continue
            seen.add(s)
            e = CANDIDATE.match(text, s).end()
            before = bisect_left(starts, e)
            if before and ends[before - 1] > s:
                continue
            own = text[s:e]
            if measurable(own) and novelty.share(text, s, e) >= (letters if own.isalpha() else threshold):
                found.append((s, e, "novel"))
                last = e
    return found


def learned_words(df: DataFrame, text: str = "text", most: int = LEARNED) -> list[str]:
    """The words that stand next to sensitive ones most often, over all rows; words of letters and underscores, so no keys. At most `most` reach the driver."""

    def run(batches):
        for b in batches:
            n: Counter = Counter()
            for t in b.column(0).to_pylist():
                for c in CONTEXT.finditer(t or ""):
                    n.update(WORDS.findall(t, max(0, c.start() - REACH), c.end() + REACH))
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    got = map_texts(df.select(column(text)), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in got.orderBy(F.desc("n"), "word").limit(most).collect()]


#: A word at its ends: what is longer or has digits beside it is left out.
WORDS = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z_]{3,24}(?![A-Za-z0-9_])", re.ASCII)


def secret_spans(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = NOVEL, learned: list[str] = ()) -> DataFrame:
    """key and found: array of (kind, start, end), by start, of every row, whole texts; a narrow map, no shuffle.

    learned: see learned_words. A null text counts as empty and has none. Repeated rows each get a row; an empty table
    gives none. Spans of different kinds may overlap; those of one kind don't. Other columns are not read.
    """
    dictionary = primer(learned)

    def run(batches):
        novelty = worker_state(f"novelty:{zlib.crc32(dictionary)}", lambda: Novelty(dictionary))
        for b in batches:
            found = []
            for t in b.column(1).to_pylist():
                base = base_spans(t or "")
                found.append([{"kind": k, "start": s, "end": e} for s, e, k in sorted([*base, *novel_spans(t or "", base, novelty, threshold)], key=lambda x: (x[0], ORDER[x[2]]))])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], names=[key, "found"])

    kind = df.schema[key].dataType.simpleString()
    return map_texts(df.select(column(key), column(text)), run, f"`{key}` {kind}, found array<struct<kind:string,start:long,end:long>>")


ORDER = {"assign": 0, "access": 1, "hex": 2, "novel": 3}


def redacted(text: str, spans: list[tuple[int, int, str]], mask: str = "[REDACTED]") -> str:
    """text with each span, or run of overlapping spans, replaced by mask."""
    out, at = [], 0
    for s, e, _ in sorted(spans):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])

