"""Token counts: byte-pair merging with a heap over a linked list, counting only.

A word's count is its number of initial symbols minus the merges applied to it; token identifiers are never made.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import map_texts, worker_state

#: Entries of a worker's word cache before it starts anew; a bound on memory only, counts do not depend on it.
CACHE_WORDS = 400_000


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte that byte-level vocabularies use: printable Latin-1 stays, others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(own)]
    to = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}
    return [to[b] for b in range(256)]


class MergeCounter:
    """Counts tokens of a BPE vocabulary file whose words end in a suffix and are lower-cased (tokenizers' JSON format)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.suffix = model["end_of_word_suffix"] or ""
        self.bytes = byte_symbols()
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        kinds = {n["type"] for n in spec["normalizer"]["normalizers"]}
        self.nfc, self.lower = "NFC" in kinds, "Lowercase" in kinds
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.seen: dict[str, int] = {}

    def count_word(self, word: str) -> int:
        """Initial symbols minus merges. The heap holds (rank, left position) of pairs; stale entries are skipped."""
        sym = [self.bytes[b] for b in word.encode()]
        sym[-1] += self.suffix
        n = len(sym)
        if n == 1:
            return 1
        rank = self.rank
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i) for i in range(n - 1) if (r := rank.get((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if sym[i] is None or j < 0 or rank.get((sym[i], sym[j])) != r:
                continue
            sym[i] += sym[j]
            sym[j] = None
            merges += 1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank.get((sym[i], sym[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := rank.get((sym[h], sym[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return n - merges

    def _plain(self, text: str) -> int:
        if self.nfc and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self.lower:  # one character at a time, as the library does: no final sigma
            text = text.replace("Σ", "σ").lower()
        seen, total = self.seen, 0
        for w in self.word.findall(text):
            n = seen.get(w)
            if n is None:
                if len(seen) >= CACHE_WORDS:
                    seen.clear()
                n = seen[w] = self.count_word(w)
            total += n
        return total

    def count(self, text: str) -> int:
        """Special strings inside a text are one token each, as the library's default has it."""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


def token_counts(df: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limit: int = 2048) -> DataFrame:
    """keep, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row; a narrow map, no shuffle.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows each get a row; an empty table gives none. Other
    columns of df are not read. vocabulary: path of the file on every executor.
    """

    def count(batches):
        counter = worker_state(f"merges:{vocabulary}", lambda: MergeCounter(vocabulary))
        for b in batches:
            texts = [t or "" for t in b.column(len(keep)).to_pylist()]
            n = [counter.count(t) for t in texts]
            size = [len(t.encode()) for t in texts]
            made = [pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *made], names=[*keep, "n_bytes", "n_tokens", "over_limit"])

    own = df.select(*keep, F.col(text))
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return map_texts(own, count, f"{schema}, n_bytes long, n_tokens long, over_limit boolean")
