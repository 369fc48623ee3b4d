import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerloom.llm import conversations, ordering, tour

SCHEMA = "conv_id long, turn long, role string, text string, node long, parent long, at long, depth long, block long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, 0, 0, 0) for r in rows], SCHEMA)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), key, role, text))
    plain = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in plain:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        turns = tuple(plain.get(base, [])[:h] + plain[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = Counter(t[:-1] for t in members if t)
    leaves, saved = Counter(), Counter()
    for t, cs in members.items():
        for d in range(len(t) + 1):
            leaves[t[:d]] += t not in children
            saved[t[:d]] += (len(cs) - 1) * len(t[-1][1].encode()) if t else 0
    return {
        (min(cs), len(t), min(members[t[:-1]]) if t else None, len(cs), children[t], leaves[t], saved[t],
         hashlib.sha256(",".join(map(str, sorted(ends[t]))).encode()).hexdigest())
        for t, cs in members.items()
    }


def found(spark, rows):
    result = [tuple(r) for r in conversations.prefix_trie(table(spark, rows)).collect()]
    assert len(result) == len(set(result))
    return set(result)


def sample(rng, conversations_, openings):
    rows = []
    for c in conversations_:
        opening = rng.choice(openings)
        for n in range(rng.randrange(0, 9)):
            text = opening[n] if n < len(opening) and rng.random() < 0.9 else f"été {rng.randrange(3)}"
            rows.append((c, n, "user" if n % 2 == 0 else "assistant", text))
    return rows


@pytest.mark.parametrize("core,block,piece", [(4096, 64, 1 << 20), (4, 2, 8)])
def test_against_brute_force(spark, monkeypatch, core, block, piece):
    monkeypatch.setattr(tour, "CORE", core)
    monkeypatch.setattr(conversations, "BLOCK", block)
    monkeypatch.setattr(conversations, "PIECE_BYTES", piece)
    rng = random.Random(4)
    rows = sample(rng, range(-20, 150), [["hello"] * 8, ["a", "b", "c"], ["a", "b", "d", "e"]])
    # One conversation with many turns and one of its copies, ends in common, ties, repeated rows, missing values.
    rows += [(c, n, "user", f"step {n}") for c in (500, 505) for n in range(150)]
    rows += [(c, 0, "user", "hot") for c in range(1000, 1200)]
    rows += [(700, None, None, None), (700, 3, "b", "x"), (700, 3, "a", "y"), (700, 3, "a", "y"), (None, 1, "user", "no one's")]
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_few_rows(spark):
    assert found(spark, []) == set()
    assert found(spark, [(None, 0, "user", "x")]) == set()
    assert found(spark, [(7, 0, "user", "x")]) == brute([(7, 0, "user", "x")])
    # Without a base and with fewer turns than it skips, a conversation has no turns.
    turnless = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    (row,) = found(spark, [(turnless, 0, "user", "x")])
    assert row[:7] == (turnless, 0, None, 1, 0, 1, 0)


def test_roles_and_texts_are_kept_apart(spark):
    rows = [(0, 0, "ab", "c"), (100, 0, "a", "bc"), (200, 0, "", "abc"), (300, 0, None, "abc")]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("core", [2, 50])
def test_lists_are_ranked_in_rounds(spark, monkeypatch, core):
    monkeypatch.setattr(tour, "CORE", core)
    rng = random.Random(8)
    order = rng.sample(range(10**6), 400)
    rows = [
        (a, order[n - 1] if n else None, order[n + 1] if n + 1 < len(order) else None, 1 if n else 0, rng.randrange(5) if n else 0)
        for n, a in enumerate(order)
    ]
    ranks = tour.ranked(spark.createDataFrame(rows, "arc long, prev long, next long, rank long, w long"), ["rank", "w"]).collect()
    total, want = 0, {}
    for n, r in enumerate(rows):
        total += r[4]
        want[r[0]] = (n, total)
    assert {r["arc"]: (r["rank"], r["w"]) for r in ranks} == want


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "1k")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def test_places_and_neighbours_in_a_hot_group(spark, small_ranges):
    rng = random.Random(2)
    rows = [(1 if rng.random() < 0.6 else rng.randrange(20), n) for n in rng.sample(range(10**6), 600)]
    df = spark.createDataFrame(rows, "g long, v long")
    groups = defaultdict(list)
    for g, v in sorted(rows):
        groups[g].append(v)
    placed = {(r["g"], r["v"]): r["at"] for r in ordering.numbered(df, "g", ["v"], "at").collect()}
    assert placed == {(g, v): n for g, vs in groups.items() for n, v in enumerate(vs)}
    after = {(r["g"], r["v"]): (r["next"], r["first"]) for r in ordering.with_following(df, "g", "v", "v", "next", "first").collect()}
    assert after == {(g, v): (vs[n + 1] if n + 1 < len(vs) else None, n == 0) for g, vs in groups.items() for n, v in enumerate(vs)}
    ranges = ordering._ranged(df, "g", ["v"], "part")
    assert ranges.filter("g = 1").select("part").distinct().count() > 1
