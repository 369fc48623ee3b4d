import collections
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import documents, prose
from ledgerloom.llm import packing, vocabularies

VOCABULARY, RANKS, PATTERN = vocabularies.byte_bpe()


@pytest.fixture(scope="module")
def encoder():
    with open(VOCABULARY, encoding="utf-8") as a, open(RANKS, "rb") as b:
        return packing.Encoder(a.read(), b.read(), PATTERN)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def plain_ids(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


PARTS = ["the", " ", "  ", "\n", "\t", "\r\n", "\x1f", "\x85", "é", "ǅ", "²", "½", "don't", "'ll", "123", "!!", "_", "日本", "🙂", "<|endoftext|>", "\u00a0", "ª", "x" * 300, "..."]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
def test_ids_equal_those_of_the_library(encoder, library, text):
    assert encoder.ids(text) == plain_ids(library, text)


def test_ids_of_real_texts(encoder, library, spark, folder):
    for r in spark.read.parquet(f"{folder}/documents.parquet").limit(80).collect():
        assert encoder.ids(r["text"]) == plain_ids(library, r["text"])


def test_pieces_cover_documents_and_fill_sequences(spark, library, folder):
    rng = random.Random(4)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows += [(9001, None), (9002, ""), (9003, prose(rng, ["alpha", "beta", "gamma."], 60_000)), (9004, rows[0][1]), (9004, rows[0][1]), (None, "no id"), (2**60 + 1, "large id")]
    docs = documents(spark, rows, "row_no length sequence_id group_no offset start")
    found = packing.pack(docs, VOCABULARY, RANKS, PATTERN).collect()
    pieces, copies = collections.defaultdict(list), collections.Counter(i for i, _ in rows)
    for r in found:
        pieces[r["doc_id"]].append(r)
    for i, text in dict(rows).items():
        ids = plain_ids(library, text) + bytes(4)
        total, at = len(ids) // 4, 0
        own = collections.Counter((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces[i])
        for start in range(0, total, 1024):
            n = min(1024, total - start)
            key = (start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), total)
            assert own[key] == copies[i]
            at += own[key]
        assert at == sum(own.values())
    sequences = collections.defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    used = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
        used += end
    assert used / (1024 * len(sequences)) > 0.97


def test_best_fit_takes_the_tightest_window():
    # 600 and 500 open windows; 420 fits only the second tightly; 400 fills the first.
    assert packing.best_fit([600, 580, 440, 424], 1024) == [(0, 0), (1, 0), (1, 580), (0, 600)]
    rng = random.Random(1)
    lengths = sorted((rng.randint(1, 1023) for _ in range(500)), reverse=True)
    rooms, out = [], []
    for n in lengths:
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(1024 - n)
        else:
            rooms[rooms.index(fit)] -= n
        out.append(fit)
    placed = packing.best_fit(lengths, 1024)
    assert [1024 - o if o else None for _, o in placed] == out
    assert max(w for w, _ in placed) + 1 == len(rooms)


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), VOCABULARY, RANKS, PATTERN).count() == 0
