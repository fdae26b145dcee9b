"""The other operators, against plain Python, the tokenizers' libraries and labels held out."""

import contextlib
import hashlib
import json
import random
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import plain
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import bpe_count, edit_embedding, ngram_join, packing, quality, substring_dedup, toxicity
from tidemill.llm.blobs import pack_sorted, unpack_sorted
from tidemill.llm.graph import components
from tidemill.llm.run_index import RunIndex

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counts():
    return bpe_count.counter(bpe_count.Vocabulary.from_sentencepiece(MODEL))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁abcdetho.,é日😀<s>0x41"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_token_counts_of_any_text(counts, text):
    import sentencepiece

    model = test_token_counts_of_any_text.__dict__.setdefault("model", sentencepiece.SentencePieceProcessor(model_file=MODEL))
    assert counts(text) == len(model.encode(text))


def test_token_counts(docs, none, unnamed, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = bpe_count.token_counts(docs, MODEL, 100)
    want = sorted((i, len(t.encode()), n := len(model.encode(t)), n > 100) for i, t in texts)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert bpe_count.token_counts(none, MODEL).count() == 0 and bpe_count.token_counts(unnamed, MODEL).count() == 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60))
def test_best_fit_plan(lengths):
    rooms = []  # plain best fit decreasing
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(30 - n)
    used = defaultdict(list)
    plan = sorted(packing.best_fit_plan(Counter(lengths), 30))
    for n, many in Counter(lengths).items():
        mine = [p for p in plan if p[0] == n]
        for rank in range(many):
            _, first, each, sequence, offset = [p for p in mine if p[1] <= rank][-1]
            used[sequence + (rank - first) // each].append((offset + (rank - first) % each * n, n))
    for places in used.values():
        ends = [0, *(o + n for o, n in sorted(places))]
        assert [o for o, _ in sorted(places)] == ends[:-1]
    assert sorted(30 - sum(n for _, n in p) for p in used.values()) == sorted(rooms)


@pytest.mark.parametrize(
    ("part", "change"),
    [("pre_tokenizer", None), ("pre_tokenizer", {"add_prefix_space": True}), ("pre_tokenizer", {"use_regex": False}), ("normalizer", {"type": "Lowercase"}), ("normalizer", {"type": "NFD"}), ("model", {"ignore_merges": True})],
)
def test_packing_by_a_file_that_cuts_otherwise(tmp_path, part, change):
    """Such a file's ids come from its own library, whatever the pattern would give."""
    from tokenizers import Tokenizer

    told = json.loads(Path(RANKS).read_text(encoding="utf-8"))
    told[part] = change and {**(told[part] or {}), **change}
    other = tmp_path / "other.json"
    other.write_text(json.dumps(told), encoding="utf-8")
    text = "Say it isn't so:  Über-Maß, 12 apples\n\nÉtude"
    assert packing.splits_as_pattern(RANKS) and not packing.splits_as_pattern(str(other))
    assert packing.token_ids(text, str(other)) == Tokenizer.from_file(str(other)).encode(text, add_special_tokens=False).ids


def test_packing(docs, none, texts, monkeypatch):
    monkeypatch.setattr(packing, "LEAST_ROWS", 3)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.packed(docs, RANKS, 256).collect()
    want = []
    for i, t in texts:
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 256):
            part = np.array(ids[s : s + 256], "<u4")
            want.append((i, s, len(part), zlib.crc32(part.tobytes()), len(ids)))
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) == len(plain.rooms([w[2] for w in want], 256))
    assert packing.packed(none, RANKS).count() == 0


@pytest.mark.parametrize("text", ["-" * 2_000_000, "a" * 2_000_000, "a" + " " * 2_000_000 + "b", "\n" * 1_000_000, "<|endoftext|>x" + "\u00a0\t" * 600_000])
def test_packing_of_long_whitespace(spark, text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    assert tokenizer.decode(want[:-1], skip_special_tokens=False) == text
    got = packing.packed(spark.createDataFrame([(1, text), (2, "one two")], "doc_id long, text string"), RANKS).collect()
    mine = sorted((r["start"], r["length"], r["ids_crc32"]) for r in got if r["doc_id"] == 1)
    cut = [np.array(want[s : s + 2048], "<u4") for s in range(0, len(want), 2048)]
    assert mine == [(2048 * k, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(cut)]
    assert {r["doc_tokens"] for r in got if r["doc_id"] == 1} == {len(want)} and {r["doc_id"] for r in got} == {1, 2}


def near_components(rows):
    label, sets = plain.components([t for _, t in rows]), [plain.shingles(t) for _, t in rows]
    least = {}
    for k, (i, _) in zip(label, rows, strict=True):
        if i is not None:
            least[k] = min(i, least.get(k, i))
    return Counter((i, len(s), least.get(k) if s else i) for k, (i, _), s in zip(label, rows, sets, strict=True))


def variants():
    """A text and many edited forms of it, chains of them, and texts that share a passage only."""
    from samples import VOCABULARY

    r = random.Random(5)
    base = [r.choice(VOCABULARY) for _ in range(120)]
    out = []
    for k in range(60):
        w = list(base)
        for _ in range(k % 6):
            w[r.randrange(len(w))] = f"edit{k}x{r.randrange(99)}"
        out.append(" ".join(w))
    for k in range(30):
        out.append(" ".join([*base[:40], *(r.choice(VOCABULARY) for _ in range(20 + k))]))
    chain = [f"c{i}" for i in range(60)]
    for k in range(15):
        out.append(" ".join(chain[3 * k : 3 * k + 40]))
    return [(5000 - i, t) for i, t in enumerate(out)]


def test_ngram_join(spark, docs, none, unnamed, texts):
    more = variants()
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string")).unionByName(unnamed.select("doc_id", "text"))
    rows = texts + more + [(r["doc_id"], r["text"] or "") for r in unnamed.collect()]
    got = ngram_join.near_duplicates(both)
    assert Counter(tuple(r) for r in got.collect()) == near_components(rows)
    assert ngram_join.near_duplicates(none).count() == 0
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({i for i, _, c in near_components(texts) if i == c})


@pytest.mark.parametrize("frequent", [1, 2, 256])
def test_ngram_join_in_small_cells(spark, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "CELL", 4)
    monkeypatch.setattr(ngram_join, "FLUSH", 500)
    monkeypatch.setattr(ngram_join, "FREQUENT_IN_PACK", frequent)
    rows = variants()
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == near_components(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (-5, 100)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((-5, 100, 101, 102), -5)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=50))
def test_packed_numbers(values):
    values = np.sort(np.array(values, np.uint64))
    assert (unpack_sorted(pack_sorted(values), len(values)) == values).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=40), min_size=1, max_size=6), st.lists(st.text("abc", min_size=1, max_size=40), min_size=1, max_size=4))
def test_matching_statistics(texts, queries):
    index = RunIndex([t.encode() for t in texts])
    pointer, joined, begin = index.matching([q.encode() for q in queries], 64)
    text = index.text.tobytes()

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    for q, b in zip(queries, begin, strict=True):
        for k in range(len(q)):
            best = max((common(t[i:], q[k:]) for t in texts for i in range(len(t))), default=0)
            if best:
                assert common(text[pointer[b + k] :], q[k:].encode()) == best


def cut(rows):
    first, out = {}, []
    for i, t in sorted(((i, t.encode()) for i, t in rows if i is not None), key=lambda x: x[0]):
        gone = bytearray(len(t))
        for s in range(len(t) - 49):
            if first.setdefault(t[s : s + 50], i) < i:
                gone[s : s + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), sum(1 for j in range(len(gone)) if gone[j] and not (j and gone[j - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("crowded", "in_pack"), [(5000, 128), (1, 128), (5000, 1), (3, 3)])
def test_substring_dedup(spark, docs, none, texts, monkeypatch, crowded, in_pack):
    from samples import prose

    monkeypatch.setattr(substring_dedup, "CROWDED", crowded)
    monkeypatch.setattr(substring_dedup, "CROWDED_IN_PACK", in_pack)
    monkeypatch.setattr(substring_dedup, "CHUNK", 1000 if in_pack == 3 else 1 << 24)
    monkeypatch.setattr(substring_dedup, "FLUSH", 400)
    monkeypatch.setattr(substring_dedup, "IN_BUCKET", 1)
    passage, rep = prose(77, 40), "abcdefg " * 60
    more = [(500 + i, prose(200 + i, i % 9) + passage[i % 7 :] + prose(300 + i, 10)) for i in range(25)] + [(600, rep), (601, rep[3:] + "q"), (602, "é" * 40), (603, "é" * 25 + "z"), (604, "x" * 49), (605, "zz" + "é" * 30)]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    assert sorted(tuple(r) for r in substring_dedup.repeats(both).collect()) == cut(texts + more)
    if crowded > 1:
        assert substring_dedup.repeats(none).count() == 0


def test_rows_without_an_id_keep_all(spark, unnamed):
    got = substring_dedup.repeats(unnamed.unionByName(unnamed)).collect()
    assert len(got) == 4 and all(r["n_removed"] == 0 for r in got)


def test_disk_of_substring_dedup_follows_the_bytes(spark, monkeypatch):
    """a pack for each pair of buckets, and the shuffle of all contexts that stayed until the end, filled the disk."""
    from samples import prose

    def shuffled():
        sizes = 0
        for p in Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*.data"):
            with contextlib.suppress(FileNotFoundError):
                sizes += p.stat().st_size
        return sizes

    seen, fetched = [], substring_dedup._fetched
    monkeypatch.setattr(substring_dedup, "_fetched", lambda rows, met, *more: (seen.append(met), fetched(rows, met, *more))[1])
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 10_000)
    rows = [(k, prose(1, 900) + prose(2 + k, 700) + prose(1, 900)[k:]) for k in range(30)]
    n_buckets = -(-sum(len(t.encode()) for _, t in rows) // 10_000)
    assert n_buckets > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2).cache()
    assert docs.count() == 30
    before = shuffled()
    out = substring_dedup.repeats(docs)
    for _ in range(50):  # files go in the background
        if shuffled() - before < 20_000:
            break
        time.sleep(0.2)
    assert shuffled() - before < 20_000
    assert seen[0].count() <= 2 * n_buckets * (3 * n_buckets // 8)
    assert sorted(tuple(r) for r in out.collect()) == cut(rows)


def test_anchors_are_dealt_evenly(spark):
    """Parts of equal width gave the first of 32 buckets a third of all anchors."""
    raw = np.random.default_rng(3).integers(97, 123, 400_000, np.uint8)
    docs = spark.createDataFrame([(k, raw[k * 4000 : (k + 1) * 4000].tobytes().decode()) for k in range(100)], "doc_id long, text string")
    many = [r["n"] for r in substring_dedup._dealt(docs, 32, 4).where("bucket < 32").groupBy("bucket").sum("many").toDF("bucket", "n").collect()]
    assert len(many) == 32 and max(many) < 1.3 * sum(many) / 32 and min(many) > 0.7 * sum(many) / 32


def test_edit_embedding(docs, none, unnamed, texts):
    got = edit_embedding.fingerprints(docs).collect()
    order = sorted(texts)

    def bits(text):
        return np.unpackbits(np.frombuffer(bytes.fromhex(edit_embedding.fingerprint(text)), np.uint8))

    want = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        m = len(t) // 4
        edited = t[: len(t) - m] + after[:m]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), edit_embedding.fingerprint(t), edit_embedding.fingerprint(edited), edit_embedding.likeness(bits(t), bits(edited)), edit_embedding.likeness(bits(t), bits(after))))
    assert sorted(tuple(r) for r in got) == sorted(want)
    long = [r for r in got if r["n_chars"] > 300 and r["doc_id"] < 40]
    assert np.mean([r["near_edited"] for r in long]) > 0.7 > 0.3 > np.mean([r["near_next"] for r in long])
    assert edit_embedding.fingerprints(none).count() == 0 and edit_embedding.fingerprints(unnamed).count() == 2


def brute_groups(texts, least=0.75):
    """The near pairs of different fingerprints, and the group of each fingerprint by all of them."""
    prints = sorted({edit_embedding.fingerprint(t) for t in texts})
    bits = np.frombuffer(bytes.fromhex("".join(prints)), np.uint64).reshape(-1, 4)
    pairs = []
    for k in range(1, len(prints)):
        apart = np.bitwise_count(bits[:k] ^ bits[k]).sum(axis=1, dtype=np.int64)
        pairs += [(prints[j], prints[k]) for j in np.flatnonzero(1 - 2 * apart / 256 >= least)]
    return pairs


@pytest.mark.parametrize("bucket", [50_000, 8])
def test_near_documents_of_the_tables(spark, monkeypatch, bucket):
    """Of all near pairs, found by comparing all fingerprints, at least nine in ten are in one group; and groups hold near ones only."""
    monkeypatch.setattr(edit_embedding, "BUCKET", bucket)
    monkeypatch.setattr(edit_embedding, "CROSS", 4 if bucket == 8 else 4_096)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 4000")
    got = {r["doc_id"]: r["near_id"] for r in edit_embedding.near_documents(docs).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert got.keys() == texts.keys() and all(n <= i and got[n] == n for i, n in got.items())
    of = {}
    for i, t in texts.items():
        p = edit_embedding.fingerprint(t)
        assert of.setdefault(p, got[i]) == got[i]  # equal fingerprints are in one group
    pairs = brute_groups(texts.values())
    met = sum(of[a] == of[b] for a, b in pairs)
    assert len(pairs) >= 10 and met >= 0.9 * len(pairs)
    allowed = {p: p for p in of}

    def root(p):
        while allowed[p] != p:
            p = allowed[p]
        return p

    for a, b in pairs:
        allowed[root(a)] = root(b)
    by_group = defaultdict(set)
    for p, g in of.items():
        by_group[g].add(root(p))
    assert all(len(roots) == 1 for roots in by_group.values())


@pytest.mark.parametrize(("bucket", "cross", "dealt"), [(50_000, 4_096, 4_000_000), (6, 4, 100)])
def test_near_documents_of_planted_edits(spark, monkeypatch, bucket, cross, dealt):
    """Of hundreds of edited texts at least nine in ten near pairs are in one group, also where all buckets are cut."""
    for name, value in (("BUCKET", bucket), ("CROSS", cross), ("DEALT", dealt)):
        monkeypatch.setattr(edit_embedding, name, value)
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 3000 AND length(text) BETWEEN 400 AND 3000").orderBy("doc_id").limit(500).collect()
    r, texts = np.random.default_rng(11), {}
    for row in rows:
        t = row["text"]
        texts[2 * row["doc_id"]] = t
        for _ in range(3):
            at, size = int(r.integers(0, len(t))), int(r.integers(1, 8))
            t = t[:at] + "".join(chr(97 + c) for c in r.integers(0, 26, int(r.integers(0, 8)))) + t[at + size :]
        texts[2 * row["doc_id"] + 1] = t
    got = {x["doc_id"]: x["near_id"] for x in edit_embedding.near_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    of = {edit_embedding.fingerprint(t): got[i] for i, t in texts.items()}
    pairs = brute_groups(texts.values())
    assert len(pairs) >= 200 and sum(of[a] == of[b] for a, b in pairs) >= 0.9 * len(pairs)


def test_the_first_near_one_by_brute_force():
    r = np.random.default_rng(5)
    among = r.integers(0, 1 << 63, (30, 4), np.uint64)
    prints = among[r.integers(0, 30, 200)] ^ np.where(r.random((200, 4)) < 0.85, r.integers(0, 1 << 10, (200, 4), np.uint64), r.integers(0, 1 << 63, (200, 4), np.uint64))
    want = [next((k for k, a in enumerate(among) if 1 - 2 * sum(int(x).bit_count() for x in a ^ p) / 256 >= 0.75), -1) for p in prints]
    assert edit_embedding.first_near(prints, among, 0.75).tolist() == want and {-1} < set(want)
    assert edit_embedding.first_near(prints[:0], among, 0.75).tolist() == [] and set(edit_embedding.first_near(prints, among[:0], 0.75)) == {-1}


def test_buckets_follow_the_texts(spark, docs, none):
    from tidemill.llm.tables import buckets_for, partitions

    least, whole = partitions(spark), sum(len((r["text"] or "").encode()) for r in docs.collect())
    assert buckets_for(docs, 1 << 40) == buckets_for(none, 1) == least
    assert buckets_for(docs, 100) == -(-whole // 100) > least


def test_near_documents_of_odd_rows(spark, docs, none, unnamed):
    rows = edit_embedding.near_documents(docs.select("doc_id", "text").unionByName(unnamed.select("doc_id", "text"))).collect()
    assert len(rows) == docs.count() + 2
    group = {r["doc_id"]: r["near_id"] for r in rows if r["doc_id"] not in (9, None)}
    assert group[40] == 3 and edit_embedding.near_documents(none).count() == 0  # a copy; an empty table
    assert len({group[i] for i in range(0, 40) if i != 9}) >= 35


def test_leaders_need_few_comparisons_for_copies():
    r = np.random.default_rng(2)
    one = r.integers(0, 1 << 63, 4, np.uint64)
    prints = np.repeat(one[None, :], 20_000, axis=0) ^ (np.uint64(1) << r.integers(0, 20, (20_000, 4), np.uint64))
    assert (edit_embedding.leaders(prints, np.arange(20_000), 0.75) == 0).all()


def test_order_of_many_rows_without_ids(spark):
    rows = [(None, f"text {k % 37}") for k in range(300)] + [(k, f"t{k}") for k in range(50)] + [(7, "a"), (7, "b")]
    got = edit_embedding.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter((i, len(t)) for i, t in rows)
    seven = sorted(t for i, t in rows if i == 7)
    after = {a: b for a, b in zip(seven, [*seven[1:], "t8"], strict=True)}
    edited = {hashlib.sha256((t[: len(t) - len(t) // 4] + after[t][: len(t) // 4]).encode()).hexdigest() for t in seven}
    assert {r["edited_sha256"] for r in got if r["doc_id"] == 7} == edited


def test_near_pairs(spark):
    from samples import prose

    texts = [prose(i, 200) for i in range(30)]
    near = [t.replace(" ba ", " so ", 2) + " end" for t in texts]
    prints = [edit_embedding.fingerprint(t) for t in texts + near]
    got = {frozenset((r["fingerprint"], r["near"])) for r in edit_embedding.near_pairs(spark.createDataFrame([(p,) for p in prints], "fingerprint string"), 0.7).collect()}

    def bits(p):
        return np.unpackbits(np.frombuffer(bytes.fromhex(p), np.uint8))

    alike = {frozenset(p) for p in zip(prints[:30], prints[30:], strict=True) if p[0] != p[1] and edit_embedding.likeness(bits(p[0]), bits(p[1])) >= 0.7}
    assert len(alike) >= 10 and len(got & alike) >= 0.9 * len(alike)
    assert got <= {frozenset(p) for p in zip(prints[:30], prints[30:], strict=True)}


@pytest.mark.parametrize("cell", [512, 16])
def test_near_pairs_in_full_buckets(spark, monkeypatch, cell):
    """Fingerprints that agree in all but 96 bits, so that buckets hold many unrelated ones."""
    monkeypatch.setattr(edit_embedding, "CELL", cell)
    r = np.random.default_rng(1)
    bits = np.tile(r.integers(0, 2, 256, np.uint8), (1500, 1))
    bits[:, r.choice(256, 96, replace=False)] = r.integers(0, 2, (1500, 96), np.uint8)
    copies = bits[:500].copy()
    for k, row in enumerate(copies):
        row[r.choice(256, 1 + k % 32, replace=False)] ^= 1
    bits = np.concatenate([bits, copies])
    prints = [np.packbits(b).tobytes().hex() for b in bits]
    apart = (bits[:, None, :] != bits[None, :, :]).sum(axis=2)
    shared = np.zeros(apart.shape, bool)
    for pick in edit_embedding._picks(32, 16):
        shared |= (bits[:, None, pick] == bits[None, :, pick]).all(axis=2)
    near = np.tril(1 - 2 * apart / 256 >= 0.75, -1)
    want = {frozenset((prints[i], prints[j])) for i, j in zip(*np.nonzero(near & shared), strict=True)}
    rows = edit_embedding.near_pairs(spark.createDataFrame([(p,) for p in prints], "fingerprint string")).collect()
    got = {frozenset((x["fingerprint"], x["near"])) for x in rows}
    assert len(rows) == len(got) and all(x["near"] < x["fingerprint"] for x in rows)
    assert got == want and len(got) >= 0.95 * near.sum()
    copied = {frozenset((prints[k], prints[1500 + k])) for k in range(500)}
    assert len(got & copied) >= 0.95 * len(copied)


@pytest.mark.parametrize("n_docs", [4000, 6000])
@pytest.mark.parametrize(("module", "label", "folds", "held", "fit", "threshold", "least"), [(toxicity, "toxic", 5, 0, "toxicity", 0.5, 0.92), (quality, "quality", 4, 2, "quality", 0.7, 0.98)])
def test_classifiers(spark, none, unnamed, module, label, folds, held, fit, threshold, least, n_docs):
    """On labels held out: better than always giving the more frequent answer, and the threshold is near the best there is for the scores."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(f"doc_id < {n_docs}")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    score = getattr(module, fit)
    got = {r["doc_id"]: r for r in score(docs, labels).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % folds == held) for i, r in got.items())
    known = [(got[r["doc_id"]]["score"], got[r["doc_id"]]["predicted"], r[label]) for r in labels.collect() if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    scores, predicted, truth = (np.array(x) for x in zip(*known, strict=True))
    assert len(known) > 300 and ((scores >= threshold) == predicted).all()
    right = np.mean(predicted == truth)
    assert right > least and right > max(truth.mean(), 1 - truth.mean()) + 0.03
    assert right > max(np.mean((scores >= c) == truth) for c in np.linspace(0, 1, 101)) - 0.035
    if n_docs == 4000:
        blank = score(unnamed.select("doc_id", "text"), labels.limit(0)).collect()
        assert len(blank) == 2 and {r["score"] for r in blank} == {0.5}
        assert score(none, labels).count() == 0


def test_the_threshold_follows_the_share_of_labels():
    """The same sample, said to come from rows of which a half, or one in twenty, have label 1."""
    import pyarrow as pa
    from samples import prose

    texts = [prose(k, 30) + (" zoxzox" * (1 + k % 3) if k % 2 else "") + (" zoxzox" if k % 9 == 0 else "") for k in range(120)]
    sample, known = pa.array(texts, pa.large_string()), np.array([k % 2 for k in range(120)], float)
    even, rare = (toxicity.fit(sample, known, share) for share in (0.5, 0.05))
    assert rare.intercept < even.intercept and toxicity.fit(sample, known).intercept == pytest.approx(even.intercept)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_empty_texts_keep_the_labels_in_place(module):
    """Empty and one-letter texts among the sample: each label stays with its text, so that the model tells the marked texts."""
    import pyarrow as pa
    from samples import prose

    texts = ["", "", "a", ""] + [prose(k, 60) + " zoxzox" * (6 * (k % 2)) for k in range(60)] + ["", "", "b"]
    known = np.array([0, 1, 0, 1] + [k % 2 for k in range(60)] + [1, 0, 1], float)
    model = module.fit(pa.array(texts, pa.large_string()), known)
    scores = np.array([model(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for t in texts[4:64]])
    assert scores[1::2].min() > scores[::2].max()


def test_toxicity_in_pieces(monkeypatch):
    """Texts cut into small pieces, and features kept in small parts, give the model and the scores of whole ones."""
    import pyarrow as pa
    from samples import prose

    texts = [prose(k, 40 + 9 * k) + ("" if k % 2 else " zoxzox é日本語😀 ") * (k % 5) for k in range(60)] + ["", "a", "ab", "éé", "日本"]
    sample, known = pa.array(texts, pa.large_string()), np.array([k % 2 for k in range(65)], float)

    def scores(model):
        return np.concatenate([model(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])) for t in texts])

    whole = toxicity.fit(sample, known, 0.2, bits=12)
    before = scores(whole)
    for size in (1, 7, 50):
        monkeypatch.setattr(toxicity, "PIECE_BYTES", size)
        monkeypatch.setattr(toxicity, "PART_FEATURES", 3 * size)
        assert np.allclose(scores(whole), before, atol=1e-9)
        again = toxicity.fit(sample, known, 0.2, bits=12)
        assert np.allclose(again.weights, whole.weights, rtol=1e-4, atol=1e-5) and again.intercept == pytest.approx(whole.intercept, rel=1e-5)


def test_toxicity_training_against_whole_matrices():
    """Log-count ratios and the accelerated gradient steps, as matrix products over the texts in use alone."""
    import pyarrow as pa
    from samples import prose

    texts = [prose(k, 30) + " zoxzox" * (k % 2) for k in range(50)] + ["", "x"]
    known = np.array([k % 3 == 1 or k % 2 for k in range(52)], float)
    used = np.arange(52) % 4 != 1
    x = toxicity.features(pa.array(texts, pa.large_string()), known, (3, 4), 8)
    dense = np.zeros((52, 2 << 8))
    for i, t in enumerate(texts):
        values = [plain.mix(ord(c) + 1) for c in t.translate(plain.LOWER)]
        for k, n in enumerate((3, 4)):
            grams = []
            for j in range(len(values) - n + 1):
                h = 0
                for v in values[j : j + n]:
                    h = (h * 0x9E3779B97F4A7C15 + v) & plain.M
                grams.append(((h ^ h >> 31) * 0xD6E8FEB86659FD93 & plain.M) >> 56)
            for g in grams:
                dense[i, (k << 8) + g] += 1 / len(grams)
    a, y = dense[used], known[used]
    held = [1 + (a[y == c] > 0).sum(axis=0) for c in (0, 1)]
    ratio = np.log(held[1] / held[1].sum()) - np.log(held[0] / held[0].sum())
    a = a * ratio
    scale = np.sqrt((a**2).sum(axis=1).mean())
    a /= scale
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    w = last = np.zeros(a.shape[1])
    b = last_b = 0.0
    for k in range(10):
        at, at_b = w + k / (k + 3) * (w - last), b + k / (k + 3) * (b - last_b)
        error = (1 / (1 + np.exp(-(a @ at + at_b))) - y) * share
        last, last_b, w, b = w, b, at - 4.0 * (a.T @ error + 1e-4 * at), at_b - 4.0 * error.sum()
    got, got_b = toxicity.trained(x, used, 10, 1e-4)
    assert np.allclose(got, w * ratio / scale, rtol=1e-4, atol=1e-5) and got_b == pytest.approx(b, rel=1e-5)


@pytest.mark.parametrize(("module", "label", "folds", "held", "plainly"), [(toxicity, "toxic", 5, 0, lambda m, t: plain.toxicity_score(m, t)), (quality, "quality", 4, 2, lambda m, t: plain.quality_score(m, t, quality.SCALE))])
def test_scores_of_odd_texts(spark, docs, unnamed, module, label, folds, held, plainly):
    """Each score against plain Python: null, empty, blank, short and very long texts, repeated rows, rows without an id."""
    from tidemill.llm import labelled

    train = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    twice = labels.unionByName(labels.limit(5)).unionByName(labels.limit(3).withColumn(label, 1 - labels[label]))  # repeated and contradicting labels
    sample = labelled.training_sample(train.unionByName(train.limit(20)), twice, label, folds, held, 50)
    rows = sample.collect()
    assert len(rows) == len({(r["doc_id"], r["label"]) for r in rows}) <= 100 and all(zlib.crc32(str(r["doc_id"]).encode()) % folds != held for r in rows)
    model = module.fit(*labelled.collected(sample))
    again = module.fit(*labelled.collected(sample.repartition(5)))
    assert (model.weights == again.weights).all() and model.intercept == again.intercept  # whatever the partitioning
    odd = ["", " ", "a", "ab", "abc", "é", "日本語の文章", "word " * 40_000, "no " * 3, "a\u0085b \x00c", "A-B--C"]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(700 + k, t) for k, t in enumerate(odd)], "doc_id long, text string")).unionByName(unnamed.select("doc_id", "text"))
    got = labelled.scored(more, model, folds, held, 0.5).collect()
    texts = Counter((r["doc_id"], r["text"] or "") for r in more.collect() if len(r["text"] or "") < 30_000 or r["doc_id"] == 707)
    want = sorted((i is None, i or 0, round(plainly(model, t), 6)) for (i, t), n in texts.items() for _ in range(n))
    scores = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in got)
    assert len(scores) == len(want) and all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-5 for a, b in zip(scores, want, strict=True))


def test_scores_do_not_depend_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    from pyspark.sql import functions as F

    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(map(tuple, quality.quality(docs, labels).collect())) == sorted(map(tuple, quality.quality(docs, other).collect()))


def test_very_long_texts(spark):
    """All operators on texts of more than a megabyte, beside short ones."""
    from samples import prose

    from tidemill.llm import decontaminate, licenses, secrets

    long = prose(11, 220_000)
    texts = {1: long, 2: long + " token=abcdef99 under the MIT license", 3: "short and other words of five", 4: long[: len(long) // 2] + " ÿ " * 50_000}
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, long[500_000:500_400])], "item_id long, text string")
    assert len(long) > 1_000_000
    found = {r["doc_id"]: r for r in secrets.secrets(docs).collect()}
    assert found[2]["spans"] == plain.told(plain.spans(texts[2])) and found[1]["n_assign"] == 0
    assert {r["doc_id"]: r["n_base"] for r in licenses.licenses(docs).collect()} == {1: 0, 2: 1, 3: 0, 4: 0}
    hit = {r["doc_id"]: r["n_hit"] for r in decontaminate.contamination(docs, bench).collect()}
    assert hit == {i: len(plain.contaminated(t, [(1, long[500_000:500_400])])[1]) for i, t in texts.items()} and hit[1] > 50
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    kept = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in substring_dedup.repeats(docs).collect()}
    half = long[: len(long) // 2].encode()
    assert kept[1] == (len(long.encode()), 0) and kept[3][1] == 0
    assert kept[2][1] == len(long.encode()) and kept[4][1] == len(half)
    prints = {r["doc_id"]: r for r in edit_embedding.fingerprints(docs).collect()}
    assert all(prints[i]["n_chars"] == len(t) and prints[i]["fingerprint"] == edit_embedding.fingerprint(t) for i, t in texts.items()) and prints[1]["near_next"] > 0.9
    tokens = {r["doc_id"]: r["n_tokens"] for r in bpe_count.token_counts(docs, MODEL).collect()}
    pieces = packing.packed(docs, RANKS).collect()
    ids = Counter()
    for r in pieces:
        ids[r["doc_id"]] += r["length"]
    assert ids == {r["doc_id"]: r["doc_tokens"] for r in pieces} and tokens[2] > tokens[1] > 220_000
