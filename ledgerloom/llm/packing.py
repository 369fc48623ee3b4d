"""Documents packed into sequences by best-fit decreasing.

Overlong documents are first cut into full windows, which are sequences by themselves. The rests, one per
document at most, are dealt into groups of bounded size by a hash of their row, so that no group holds more than
its share whatever ids or sources repeat. Each group places its rests, longest first, into the open window that
they leave the least room in; a segment tree over the remaining capacities finds it.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, settle, ship

WINDOW = 1024
# Rests of a group on average: enough for tight windows, little to hold in a task.
GROUP_RESTS = 4096
# Words whose ids a task keeps.
CACHE_WORDS = 700_000
# In these characters both libraries agree on what letters, digits and white space are.
UNUSUAL = re.compile("[^\x00-\x1b\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-ɏ]")
# Ids travel as text: pandas would turn numbers next to NULLs into inexact ones.
PIECES = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, row_no long"
PACKED = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Ids of texts as little-endian 32-bit numbers, equal to those of ``tokenizers`` for the vocabulary.

    A text of usual characters is cut at its spaces, as the vocabulary's own splitting does, and the ids of each
    word are looked up or made once by the faster library that has the same vocabulary as ranks. Where white
    space meets white space the cut would need to see both sides, so such a text is encoded whole. Any text with
    other characters or with a special token's name goes to ``tokenizers``.
    """

    def __init__(self, vocabulary: str, ranks: bytes, pattern: str):
        self.tokenizer = tokenizers.Tokenizer.from_str(vocabulary)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        pairs = map(bytes.split, ranks.splitlines())
        table = {base64.b64decode(a): int(b) for a, b in pairs}
        self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.known: dict[str, bytes | None] = {}

    def _make(self, word: str) -> bytes | None:
        # A word that is empty or ends in white space meets the space behind it.
        found = array("I", self.ranks.encode_ordinary(" " + word)).tobytes() if word and not word[-1].isspace() else None
        self.known[word] = found
        return found

    def ids(self, text: str) -> bytes:
        if UNUSUAL.search(text) or any(s in text for s in self.specials):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        first, *words = text.split(" ")
        known = self.known
        found = [known[w] if w in known else self._make(w) for w in words]
        if None in found or not first or first[-1].isspace():
            return array("I", self.ranks.encode_ordinary(text)).tobytes()
        return array("I", self.ranks.encode_ordinary(first)).tobytes() + b"".join(found)


class OpenWindows:
    """Windows by remaining capacity, with a segment tree of how many have each."""

    def __init__(self, size: int):
        self.size = size
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.by_room: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, room: int, change: int) -> None:
        at = self.leaves + room
        while at:
            self.count[at] += change
            at >>= 1

    def put(self, window: int, room: int) -> None:
        self.by_room[room].append(window)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """A window with the least room of at least ``need``, taken out, and its room."""
        at = self.leaves + need
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        window = self.by_room[room].pop()
        self._add(room, -1)
        return window, room


def best_fit(lengths: list[int], size: int) -> list[tuple[int, int]]:
    """Window and offset of each length, for lengths in decreasing order, none above ``size``."""
    windows, opened, out = OpenWindows(size), 0, []
    for n in lengths:
        found = windows.take(n)
        if found is None:
            found, opened = (opened, size), opened + 1
        window, room = found
        out.append((window, size - room))
        if room > n:
            windows.put(window, room - n)
    return out


def _pack_group(rests: pd.DataFrame) -> pd.DataFrame:
    rests = rests.sort_values(["length", "row_no"], ascending=[False, True], kind="stable")
    group = int(rests["group_no"].iloc[0])
    placed = best_fit([int(n) for n in rests["length"]], WINDOW)
    numbers = np.array([w for w, _ in placed], np.int64)
    return rests.drop(columns=["row_no", "group_no"]).assign(
        sequence_id=((group << 33) | numbers) * 2 + 1, offset=np.array([o for _, o in placed], np.int64)
    )


def pieces(docs: DataFrame, vocabulary: str, ranks: str, pattern: str) -> DataFrame:
    """Full windows and rest of every document, with the checksum of the ids of each."""
    with open(vocabulary, encoding="utf-8") as a, open(ranks, "rb") as b:
        sent = docs.sparkSession.sparkContext.broadcast((a.read(), b.read(), pattern))
    kept: dict[str, Encoder] = {}

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if "it" not in kept:
            kept["it"] = Encoder(*sent.value)
        row = TaskContext.get().partitionId() << 33
        names = [field.split()[0] for field in PIECES.split(", ")]
        for frame in frames:
            out: list[tuple] = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = memoryview(kept["it"].ids(text or "") + bytes(4))
                total = len(ids) // 4
                for start in range(0, total, WINDOW):
                    length = min(WINDOW, total - start)
                    out.append((doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total, row))
                    row += 1
                if len(out) >= 20_000:
                    yield _frame(out, names)
                    out = []
            yield _frame(out, names)

    return docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text").mapInPandas(encode, PIECES)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    columns = list(zip(*rows)) or [()] * len(names)
    return pd.DataFrame({n: pd.Series(c, dtype=object if n == "doc_id" else "int64") for n, c in zip(names, columns)})


def pack(docs: DataFrame, vocabulary: str, ranks: str, pattern: str) -> DataFrame:
    """One row per piece: its place in the document and in its sequence of at most 1024 tokens.

    A document is the ids of its text and one id 0, so a NULL or empty text is one token. A repeated row is a
    document of its own; a NULL doc_id stays NULL. Sequence ids are unique, not dense. An empty table has no pieces.
    Other columns are ignored. The pieces are stored once in the checkpoint folder before they are packed.
    """
    settle(docs.sparkSession)
    made = cut(pieces(docs, vocabulary, ranks, pattern))
    full = made.filter(F.col("length") == WINDOW)
    rests = made.filter(F.col("length") < WINDOW)
    groups = max(1, -(-rests.count() // GROUP_RESTS))
    dealt = rests.withColumn("group_no", F.pmod(F.xxhash64("row_no"), F.lit(groups)))
    packed = dealt.groupBy("group_no").applyInPandas(_pack_group, PACKED)
    alone = full.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("row_no") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return alone.unionByName(packed).withColumn("doc_id", F.col("doc_id").cast("long"))


ship(__name__)
