"""Token counts by byte-pair merging, without making tokens.

A word's symbols are a linked list; a heap holds the adjacent pairs that have a merge rank.  The pair of the lowest
rank (leftmost of equals) is popped and merged until none is left: the count is the initial symbols less the merges.

The tokenizer's file gives ranks and vocabulary.  Texts are prepared as that file states: special strings are
one token each; then NFC, lower case; pieces are contractions, runs of letters, single digits and runs of other
signs; white space is dropped; each byte of a piece is a symbol, the last one marked as a word's end.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import field, map_text

COLUMNS = ["n_bytes", "n_tokens", "over_limit"]
#: Counts of pieces kept in memory by each Python worker.
CACHED_PIECES = 1 << 19
#: What this module can prepare texts for; any other setting in a file is refused.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def _byte_symbols() -> list[str]:
    """The printable sign that stands for each byte in a byte-level vocabulary: itself, or the next free one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class PieceCounter:
    """Counts of tokens of one BPE file in the ``tokenizers`` format with a word-end suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or spec["normalizer"].get("normalizers") != _NORMALIZER or model["dropout"] or model["ignore_merges"] \
                or [p["type"] for p in split] != ["Split", "ByteLevel"] or not split[0]["invert"] or split[0]["behavior"] != "Removed":
            raise ValueError(f"{path}: not a kind of tokenizer that this operator prepares texts for")
        self.suffix = model["end_of_word_suffix"] or ""
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.symbols = _byte_symbols()
        missing = [s for s in self.symbols if s not in model["vocab"] or s + self.suffix not in model["vocab"]]
        if missing:
            raise ValueError(f"{path}: bytes without a token: {missing}")
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        # white space as Unicode has it (U+001C to U+001F are none)
        space = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
        self.piece = regex.compile(split[0]["pattern"]["Regex"].replace("\\s", space))
        self.of_piece = lru_cache(CACHED_PIECES)(self._of_piece)

    def _of_piece(self, piece: str) -> int:
        """Tokens of one piece: its bytes less the merges."""
        part: list[str | None] = [self.symbols[b] for b in piece.encode()]
        n = len(part)
        part[-1] += self.suffix
        ranks = self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := ranks.get((part[i], part[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if part[i] is not None else n
            if part[i] != a or j >= n or part[j] != b:
                continue  # one of the two has been merged since
            part[i], part[j] = a + b, None
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((part[i], part[k]))) is not None:
                    heapq.heappush(heap, (r, i, part[i], part[k]))
            h = before[i]
            if h >= 0 and (r := ranks.get((part[h], part[i]))) is not None:
                heapq.heappush(heap, (r, h, part[h], part[i]))
        return n - merges

    def count(self, text: str) -> int:
        if self.special is None or "<" not in text:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # sign by sign: a final sigma isn't told apart
        return sum(map(self.of_piece, self.piece.findall(text.lower())))


@lru_cache(2)
def counter(path: str) -> PieceCounter:
    """One counter for each file and Python worker."""
    return PieceCounter(path)


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", *, limit: int = 2048, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``tokenizer`` is a path that every executor can open.  Null and empty texts have no bytes and no tokens.
    Columns of those names in ``docs`` are replaced; repeated rows get equal results; an empty table gives an empty result.
    """
    def make():
        count = counter(tokenizer).count

        def run(texts):
            both = [(len(t.encode()), count(t)) for t in texts.to_pylist()]
            return [pa.array([b for b, _ in both], pa.int64()), pa.array([n for _, n in both], pa.int64())]
        return run

    found = map_text(docs, text, [field("n_bytes", "long"), field("n_tokens", "long")], make,
                     [c for c in (docs.columns if carry is None else carry) if c.lower() != "over_limit"])
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
