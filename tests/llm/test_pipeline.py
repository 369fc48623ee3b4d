import collections
import hashlib
import re
import zlib

import corpus_pipeline
from ledgerloom.llm import language, quality, vocabularies
from test_components import union_find
from test_mixing import shared_out
from test_packing import plain_ids
from test_simhash import plain_fingerprint
from tokenizers import Tokenizer


def deduplicated(rows):
    prints = {i: plain_fingerprint(r["text"]) for i, r in rows.items()}
    ids = sorted(prints)
    pairs = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 3]
    root = union_find(pairs)
    return {i: r for i, r in rows.items() if root.get(i, i) == i}


def mixed(rows):
    """(doc_id, text) of every take."""
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "") for i, r in rows.items()}
    sizes = collections.Counter()
    for i, r in rows.items():
        sizes[r["source"]] += len(words[i])
    out = []
    for source, target in shared_out(sizes).items():
        place = lambda i: f"{i}:{hashlib.md5((rows[i]['text'] or '').encode()).hexdigest()}"
        own = sorted((i for i, r in rows.items() if r["source"] == source), key=lambda i: hashlib.md5(place(i).encode()).hexdigest())
        whole = min(3, int(target // sizes[source])) if sizes[source] else 0
        rest = round(target - whole * sizes[source]) if whole < 3 else 0
        before = 0
        for i in own:
            size = len(words[i])
            out += [(i, rows[i]["text"])] * (whole + (size > 0 and 2 * before + size <= 2 * rest))
            before += size
    return out


def test_run_equals_the_plain_stages(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in docs.collect()}
    judged = {r["doc_id"]: r for r in language.identify(docs).collect()}
    rows = {i: r for i, r in rows.items() if judged[i]["lang_pred"] != "und" and judged[i]["score"] >= 0.25}
    scored = {r["doc_id"]: r["score"] for r in quality.score(docs.filter(docs.doc_id.isin(list(rows))), labels).collect()}
    rows = deduplicated({i: r for i, r in rows.items() if scored[i] >= 0.5})
    assert 0 < len(rows) < docs.count()
    library = Tokenizer.from_file(vocabularies.path("byte_bpe_50k.json"))
    wanted = collections.Counter()
    for i, text in mixed(rows):
        ids = plain_ids(library, text) + bytes(4)
        total = len(ids) // 4
        for start in range(0, total, 1024):
            n = min(1024, total - start)
            wanted[i, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), total] += 1
    found = corpus_pipeline.run(spark, folder).collect()
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in found) == wanted
    ends = collections.defaultdict(list)
    for r in found:
        ends[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
