"""Ranked search, mixing and the repair of conversations, against plain Python and SQL."""

import hashlib
import heapq
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import canonical, connection  # noqa: E402

from tidemill.llm import dialogue_repair, mixing, ranked_search  # noqa: E402
from tidemill.llm.wordhash import blocks  # noqa: E402

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return WORD.findall((text or "").translate(SMALL))


def best_by_all(docs, queries, k=10):
    """Every document scored for every query."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    corpus = [c for _, c in counted if c]
    n, total, df = len(corpus), sum(sum(c.values()) for c in corpus), Counter(w for c in corpus for w in c)
    out = []
    for item, words in queries.items():
        scored = []
        for i, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n) // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m)) for w in words if w in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [100_000, 9])
def test_ranked_search_of_odd_rows(spark, docs, none, unnamed, texts, monkeypatch, shard):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", shard)
    monkeypatch.setattr(ranked_search, "QUERY_WORDS", 1_000_000 if shard > 9 else 12)
    asked = [(1, "ba kest LOrn, mi"), (2, None), (3, ""), (4, "nothing here"), (5, texts[3][1]), (5, "vi vi zo"), (5, "vi vi zo"), (None, "one two three"), (6, "日本 ba"), (7, "one")]
    queries = spark.createDataFrame([(i, t, 1, "x") for i, t in asked], "item_id long, text string, rank int, word string")
    own = defaultdict(set)
    for i, t in asked:
        own[i] |= set(terms(t))
    both = docs.select("doc_id", "text").unionByName(unnamed.select("doc_id", "text"))
    got = sorted((tuple(r) for r in ranked_search.ranked(both, queries).collect()), key=repr)
    assert got == best_by_all([*texts, *((None, r["text"]) for r in unnamed.collect())], own)
    assert {r[0] for r in got} == {1, 5, None, 6, 7}
    assert ranked_search.ranked(none, queries).count() == 0 and ranked_search.ranked(docs, queries.limit(0)).count() == 0


def local_shard(texts, words):
    import pyarrow as pa

    known = ranked_search.Words(words)
    parts, n = [], 0
    for first, raw, offsets in blocks(pa.array(texts, pa.large_string()), 200):
        assert first == n
        lengths, doc, term, tf = known.counts(raw, offsets)
        parts.append((lengths, doc + n, term, tf))
        n += len(lengths)
    lengths, doc, term, tf = (np.concatenate(p) for p in zip(*parts, strict=True))
    ids = np.arange(n)
    return known, ranked_search.Shard(ranked_search.packed_index((ids, np.zeros(n, bool)), lengths, term, doc, tf), int((lengths > 0).sum()), max(1, int(lengths.sum())))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefgh"), max_size=40), min_size=1, max_size=80), st.lists(st.sampled_from("abcdefghz"), min_size=1, max_size=6, unique=True), st.integers(1, 12), st.integers(1, 9))
def test_block_max_maxscore(docs, query, k, block):
    old = ranked_search.BLOCK, ranked_search.FIRST_STEP, ranked_search.STEP
    ranked_search.BLOCK, ranked_search.FIRST_STEP, ranked_search.STEP = block, 3, 11
    try:
        texts = [" ".join(d) for d in docs]
        known, shard = local_shard(texts, sorted(set(query)))
        counts = [Counter(d) for d in docs if d]
        weights = {w: math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * sum(w in c for c in counts) + 1))) for w in query}
        best, scores = shard.search({known.place[w]: weights[w] for w in query}, k)
        want = best_by_all(list(enumerate(texts)), {0: query}, k)
        assert sorted((0, r, int(i), int(s)) for r, (i, s) in enumerate(zip(best, scores, strict=True), 1)) == sorted(want)
    finally:
        ranked_search.BLOCK, ranked_search.FIRST_STEP, ranked_search.STEP = old


def test_blocks_are_rejected_while_packed():
    """A query of a rare and a common word: most blocks of the common one are never unpacked."""
    texts = ["common " * (1 + k % 3) + "other " * (k % 50) + ("rare " * 3 if k % 997 == 5 else "") for k in range(40_000)]
    known, shard = local_shard(texts, ["common", "rare"])
    best, scores = shard.search({known.place["common"]: 40, known.place["rare"]: 9000}, 10)
    assert len(best) == 10 and all(k % 997 == 5 for k in best)
    assert shard.unpacked < 0.4 * len(shard.open)  # a quarter goes by until ten are found


def by_heap(votes, seats):
    """Sainte-Laguë, a seat at a time."""
    got = dict.fromkeys(votes, 0)
    heap = [(-v, u) for u, v in votes.items() if v > 0]
    heapq.heapify(heap)
    for _ in range(seats):
        _, u = heapq.heappop(heap)
        got[u] += 1
        heapq.heappush(heap, (-votes[u] / (2 * got[u] + 1), u))
    return got


def test_apportionment_by_heap(spark):
    r = random.Random(4)
    groups = {"few": ({k: float(r.randrange(1, 1000)) for k in range(7)}, 3), "ties": (dict.fromkeys(range(40), 10.0), 101), "many": ({k: r.random() ** 6 * 1e6 for k in range(60)}, 5000), "none": ({1: 5.0, 2: 0.0}, 0), "one": ({9: 2.0, 3: 0.0}, 17)}
    rows = [(g, u, v, seats) for g, (votes, seats) in groups.items() for u, v in votes.items()]
    got = mixing.apportioned(spark.createDataFrame(rows, "g string, u long, votes double, seats long"), ["g"], ["u"]).collect()
    assert len(got) == len(rows)
    assert {(x["g"], x["u"]): x["blocks"] for x in got} == {(g, u): n for g, (votes, seats) in groups.items() for u, n in by_heap(votes, seats).items()}


def filled(sizes, weights=(3, 1, 2)):
    """Targets by repeated sharing."""
    total, weight = 1.5 * sum(sizes.values()), {s: weights[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    capped = set()
    while True:
        left, w = total - sum(2 * sizes[s] for s in capped), sum(weight[s] for s in sizes if s not in capped)
        out = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / w for s in sizes}
        new = {s for s in sizes if out[s] > 2 * sizes[s]}
        if not new:
            return out
        capped |= new


@pytest.mark.parametrize("shards", [(1 << 20, 100_000), (300, 5)])
def test_mixing_of_odd_rows(spark, docs, none, unnamed, shards):
    sources = ["b", None, "ä", "a", "", "B"]
    rows = docs.select("doc_id", "text", F.element_at(F.array(*map(F.lit, sources)), (F.length(F.coalesce("text", F.lit(""))) % 6 + 1).cast("int")).alias("source"), F.lit(1).alias("key"), F.lit(2).alias("size"), F.lit("d").alias("digest"))
    rows = rows.unionByName(unnamed.select("doc_id", "text", F.lit("nil").alias("source"), F.lit(1).alias("key"), F.lit(2).alias("size"), F.lit("d").alias("digest")))
    mix = mixing.mixed(rows, shard_words=shards[0], shard_rows=shards[1])
    got = mix.collect()
    want = Counter((r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in rows.collect())
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == want
    sizes = Counter()
    for (_, source, size), n in want.items():
        sizes[source] += size * n
    target = filled(dict(sizes))
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    n_shards = len({(r["source"], r["shard"]) for r in got})
    assert all(abs(taken[s] - t) <= mixing.BLOCK_WORDS * (1 if n_shards < 10 else n_shards) for s, t in target.items())
    again = mixing.mixed(rows.repartition(7), shard_words=shards[0], shard_rows=shards[1])
    assert sorted(map(str, got)) == sorted(map(str, again.collect()))
    cut = mixing.pieces(mix).collect()
    words = Counter()
    for r in cut:
        assert 0 <= r["begin"] < r["end"]
        words[r["doc_id"]] += r["end"] - r["begin"]
    for i in {r["doc_id"] for r in got}:
        assert sum(r["taken"] - r["copies"] * r["size"] for r in got if r["doc_id"] == i) == words[i]
    assert mixing.mixed(none).count() == 0


def test_targets_of_more_words_than_32_bits_count(spark):
    sizes = {f"s{k}": 400_000_000 + 7 * k for k in range(5)} | {"s5": 30_000_000_000, "s6": 150_000_000}
    for some in (sizes, {k: v // 3 for k, v in sizes.items() if k != "s5"}):
        got = {r["key"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(some.items()), "key string, source_size long")).collect()}
        assert got == pytest.approx(filled(some))


def test_mixing_of_the_tables_in_small_shards(spark):
    """Against SQL that makes every quotient and every block."""
    sf = "/root/testdata/sf0.001"
    df = mixing.mixed(spark.read.parquet(f"{sf}/documents.parquet"), shard_words=1000, shard_rows=9).select("doc_id", "size", "source_size", "target", "taken")
    rel = connection(sf).sql(mixing.op12_sql(shard_words=1000, shard_rows=9))
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(rel.fetchall(), list(rel.columns))


# ---- conversations -------------------------------------------------------------------------------------------------


def by_walk(rows):
    """The least (cost, audit) of a conversation given as symbols, by going through its rows with the best way to each state."""
    moves = dialogue_repair.MOVES

    def insert(ways):
        for _ in range(3):
            for p, (cost, audit) in list(ways.items()):
                for (at, c), q in moves.items():
                    if at == p and c != "s":
                        ways[q] = min(ways.get(q, (99_999, "~")), (cost + 5, audit + "I"))
        return ways

    ways = insert({0: (0, "")})
    for row in rows:
        step = {p: (cost + 2, audit + "D") for p, (cost, audit) in ways.items()}
        for p, (cost, audit) in ways.items():
            for (at, c), q in moves.items():
                if at == p and row != "-" and (c == row.lower() or c != "s"):
                    edit = (cost + 5 * row.isupper() + (c != row.lower()), audit + ("K" if c == row.lower() else "R"))
                    step[q] = min(step.get(q, (99_999, "~")), edit)
        ways = insert(step)
    return min(ways[p] for p in (0, 3) if p in ways)


@settings(max_examples=300, deadline=None)
@given(st.text("suaxSUAX-", max_size=14))
def test_parse_by_walk(rows):
    cost, audit, _ = dialogue_repair.cheapest(dialogue_repair.span_cell(rows))
    assert (cost, audit) == by_walk(rows)


@settings(max_examples=60, deadline=None)
@given(st.text("suaxSUAX-", min_size=2, max_size=12), st.data())
def test_every_split_gives_the_same_cell(rows, data):
    k = data.draw(st.integers(1, len(rows) - 1))
    whole = dialogue_repair.leaf_cell(rows)
    assert dialogue_repair.combined(dialogue_repair.leaf_cell(rows[:k]), dialogue_repair.leaf_cell(rows[k:])) == whole == dialogue_repair.span_cell(rows)


def test_every_edit_of_short_conversations():
    """All edit sequences, tried: each row kept, given a role or deleted, up to two turns inserted at each place."""
    import itertools

    shape = re.compile(r"(s?(ua)+)?$")
    for rows in map("".join, itertools.product("suaU-", repeat=2)):
        best = None
        edits = [[("D", "", 2)] if r == "-" else [("D", "", 2), ("K", r.lower(), 5 * r.isupper()), ("R", "u", 1 + 5 * r.isupper()), ("R", "a", 1 + 5 * r.isupper())] for r in rows]
        holes = [(), *itertools.product("ua", repeat=1), *itertools.product("ua", repeat=2)]
        for chosen in itertools.product(*edits):
            for ins in itertools.product(holes, repeat=len(rows) + 1):
                roles = audit = ""
                cost = 0
                for k in range(len(rows) + 1):
                    roles, audit, cost = roles + "".join(ins[k]), audit + "I" * len(ins[k]), cost + 5 * len(ins[k])
                    if k < len(rows):
                        roles, audit, cost = roles + chosen[k][1], audit + chosen[k][0], cost + chosen[k][2]
                if shape.match(roles):
                    best = min(best or (99, ""), (cost, audit))
        assert dialogue_repair.cheapest(dialogue_repair.span_cell(rows))[:2] == best, rows


def plainly_repaired(rows):
    """The contract's columns for (conv_id, turn, role, text) rows before damage."""
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        conversations[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, held in conversations.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, symbols, counts = set(), "", Counter()
        for _, role, text in held:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            c = role[:1] if role[:1] in ("s", "u", "a") else "x"
            symbols += "-" if fault in ("blank", "duplicate") else c.upper() if fault else c
        cost, audit = by_walk(symbols)
        left, k = [], 0
        for edit in audit:
            if edit != "I":
                _, role, text = held[k]
                k += 1
            if edit == "K":
                left.append((role, text))
            elif edit in "RI":
                led = bool(left) and left[0][0][:1] == "s"
                left.append(("assistant" if (len(left) - led) % 2 else "user", "" if edit == "I" else text))
        turns = [t for t, _, _ in held if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(held, held[1:], strict=False)]
        said = "\n".join(f"{r}:{t}" for r, t in left)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(said.encode()).hexdigest()))
    return sorted(map(str, out))


def odd_conversations():
    r = random.Random(3)
    said = ["Yes.", "No!", "and then", "", None, " \n", "Why? ", "é…", "ok", "fine.\t", "a ", "word " * 30_000, "x" * 200_000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "System", "ümlaut"]
    rows = [(c, r.choice([None, *range(12)]) if c % 3 == 0 else t, r.choice(roles) if c % 2 else roles[t % 2], r.choice(said)) for c in range(40) for t in range(r.randrange(1, 15))]
    return rows + rows[:30] + [(None, None, None, None), (None, 3, "user", "Hello."), (77, 5, "user", "gone")] + [(99, t, roles[t % 2], f"Turn {t % 50}.") for t in range(400)] + [(98, None, "user", "same.")] * 60


@pytest.mark.parametrize("rows_in_task", [20_000, 7])
def test_dialogue_repair_of_odd_rows(spark, monkeypatch, rows_in_task):
    """As a whole and, with long conversations, in parts that meet as cells alone."""
    monkeypatch.setattr(dialogue_repair, "LONG_ROWS", rows_in_task)
    rows = odd_conversations()
    frame = spark.createDataFrame([(*x, 1, "k", 3) for x in rows], "conv_id long, turn long, role string, text string, part int, key string, gaps int")
    short, long = dialogue_repair._parted(dialogue_repair.damaged(frame), "present")
    assert (long is not None) == (rows_in_task == 7)
    got = dialogue_repair.digests(short, long)
    assert sorted(str(tuple(r)) for r in got.collect()) == plainly_repaired(rows)
    nobody = frame.limit(0)
    assert dialogue_repair.digests(*dialogue_repair._parted(nobody, None)).count() == 0


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "user", "So?"), (2, 0, "assistant", "First."), (2, 1, "user", "half"), (3, 0, "user", " ")]
    got = {r["conv_id"]: r for r in dialogue_repair.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1]["audit"] == "KKDR" and [(t["turn"], t["role"], t["edit"]) for t in got[1]["turns"]] == [(0, "system", "K"), (1, "user", "K"), (3, "assistant", "R")]
    assert (got[1]["cost"], got[1]["duplicate"]) == (3, 1)
    assert got[2]["audit"] == "DD" and got[2]["turns"] == [] and got[2]["truncated"] == 1
    assert got[3]["audit"] == "D" and got[3]["blank"] == 1
