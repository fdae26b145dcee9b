"""Operator 9: documents whose sets of word shingles are alike by Jaccard, joined by vertical partitioning.

All shingles of the corpus have one global order: rarest first. A document's shingles in that order are cut, at fixed
places of the order, into fragments; the overlap of two documents is the sum of the overlaps of their fragments, which are
counted apart, by fragment, and added per pair.

1. Documents of equal sets are one class, known by a hash of its set, and compared once.
2. Each shingle goes, packed with many others, to the bucket of its hash, where its classes are counted. Only shingles of
   two classes or more can ever match and go back to their class. Those that are frequent in a pack already go there at once.
3. Two classes can only be linked if they share one of the first shingles of either, as many as may differ and one more.
   A class whose shingles are nearly all its own drops out here.
4. Classes that share such a shingle are compared with the first of them; what links makes components. Where a shingle
   still joins different components, every class outside the largest one is compared with all of that component and with
   the others outside, in cells of bounded size. So a large group of near copies costs no pairs but those with outsiders,
   and no possible link is left out: links inside a component change nothing.

Defined results: null, empty and blank texts have an empty set and are linked with nothing; of fewer than five words the
whole sequence is the one shingle; equal rows are each told; a null id has no part in the smallest id of a component; an
empty table gives no rows; other columns are ignored; texts are taken whole. Shingles and sets are known by 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.blobs import groups, pack_sorted, squeeze, tidy, unpack_sorted, unsqueeze
from tidemill.llm.graph import components
from tidemill.llm.tables import buckets_for, checkpointed, free_name, read_table, texts
from tidemill.llm.wordhash import LOWER, blocks, joined, mix, word_hashes, words

SHINGLE, LEAST_PERCENT = 5, 75
#: The global order is cut into fragments where a shingle has this many classes.
CUTS = (3, 6, 40)
#: Shingles packed together before they are dealt to buckets, and documents on a side of a cell of comparisons.
FLUSH, CELL = 500_000, 256
#: Buckets have the shingles of about this many bytes of text at most, however few partitions the session has.
BUCKET_BYTES = 256 << 20
#: A shingle that so many classes of one pack have is frequent: its entries don't meet in the bucket of its hash, which would grow
#: with the corpus. All frequent shingles are the last in the global order, so that nobody need know how frequent they are.
FREQUENT_IN_PACK, FREQUENT_LEVEL = 64, 60_000
#: Rows that go are broadcast up to this number of ids and hashes.
BROADCAST_ROWS = 1_000_000

_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False


def shingle_sets(column: pa.Array, n: int = SHINGLE) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, rising."""
    for _, raw, offsets in blocks(column):
        raw = LOWER[raw]
        starts, ends, firsts = words(raw, offsets, _WORD)
        one = word_hashes(raw, starts, ends)
        many = joined(one, n)
        for first, last in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            if last - first >= n:
                yield np.unique(many[first : last - n + 1])
            else:
                yield joined(one[first:last], last - first) if last > first else many[:0]


def set_id(hashes: np.ndarray) -> int:
    """A 64-bit name of a set; 0 for the empty one."""
    return int(mix(np.array([mix(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))], np.uint64))[0].astype(np.int64)) if len(hashes) else 0


#: What a row of the first pass holds: shingles to be counted, shingles known to be frequent, or a document's class.
PACK, FREQUENT, RECORD = 0, 1, 2
_FIRST = "kind int, bucket int, many long, shingles binary, owners binary, cids binary, sizes binary, levels binary, doc_id long, mark long, n long, cid long"
_FIRST_TYPES = (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5, *[pa.int64()] * 4)
_FIRST_NAMES = [c.split()[0] for c in _FIRST.split(", ")]


def _mark(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(_FIRST_NAMES, _FIRST_TYPES, strict=True)], _FIRST_NAMES)


def _by_class(kind: int, cids: np.ndarray, sizes: np.ndarray, tokens: np.ndarray, levels: np.ndarray, buckets: int) -> list[dict]:
    """Entries packed by bucket of their class."""
    to = mix(cids.view(np.uint64)) % np.uint64(buckets)
    order = np.lexsort((cids, to))
    edges = np.searchsorted(to[order], np.arange(buckets + 1, dtype=np.uint64))
    picked = ((k, order[edges[k] : edges[k + 1]]) for k in range(buckets))
    return [{"kind": kind, "bucket": k, "cids": squeeze(cids[at]), "sizes": squeeze(sizes[at]), "shingles": tokens[at].tobytes(), "levels": squeeze(levels[at])} for k, at in picked if len(at)]


def _dealt(docs: DataFrame, buckets: int) -> DataFrame:
    """The only pass over the texts. For each document a record of its class; the shingles of all classes, packed by bucket of
    their hash, with those that many classes of one pack have left out and only named (``levels``); these go on by class."""

    def flush(sets: dict[int, np.ndarray]) -> pa.RecordBatch:
        cids, sizes = np.fromiter(sets, np.int64, len(sets)), np.array([len(s) for s in sets.values()], np.uint32)
        tokens = np.concatenate(list(sets.values()))
        owners = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        begin = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        runs = np.diff(np.r_[begin, len(tokens)])
        hot = np.repeat(runs >= FREQUENT_IN_PACK, runs)
        frequent = tokens[begin[runs >= FREQUENT_IN_PACK]]
        rows = _by_class(FREQUENT, cids[owners[hot]], sizes[owners[hot]], tokens[hot], np.full(int(hot.sum()), FREQUENT_LEVEL, np.uint16), buckets)
        tokens, owners = tokens[~hot], owners[~hot]
        bounds = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)
        packs = zip(np.split(tokens, np.searchsorted(tokens, bounds)), np.split(owners, np.searchsorted(tokens, bounds)), np.split(frequent, np.searchsorted(frequent, bounds)), strict=True)
        for k, (some, own, named) in enumerate(packs):
            if len(some) or len(named):
                here, owner = np.unique(own, return_inverse=True)
                owner = owner.astype(np.uint16 if len(here) < 1 << 16 else np.uint32)
                rows.append({"kind": PACK, "bucket": k, "many": len(some), "shingles": pack_sorted(some), "owners": owner.tobytes(), "cids": cids[here].tobytes(), "sizes": sizes[here].tobytes(), "levels": named.tobytes()})
        return _rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held = {}, 0
        for batch in batches:
            records = []
            for s in shingle_sets(batch.column("text")):
                cid = set_id(s)
                records.append((len(s), cid))
                if len(s) and cid not in sets:
                    sets[cid] = s
                    held += len(s)
                    if held >= FLUSH:
                        yield flush(sets)
                        sets, held = {}, 0
            many, none = len(records), [pa.nulls(len(records), t) for t in _FIRST_TYPES[2:8]]
            n, cids = pa.array([r[0] for r in records], pa.int64()), pa.array([r[1] for r in records], pa.int64())
            at = pa.array(np.arange(many) % buckets, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(many, RECORD), pa.int32()), at, *none, batch.column("doc_id"), batch.column("mark"), n, cids], _FIRST_NAMES)
        if sets:
            yield flush(sets)

    return texts(docs).withColumn("mark", _mark(F.col("text"))).mapInArrow(tidy(run), _FIRST)


def _shared(dealt: DataFrame, buckets: int) -> DataFrame:
    """The shingles of two classes or more, packed by bucket of the class (``cids``, ``sizes``, ``shingles``, ``levels``), and what else came, as
    it is. A shingle's level is its number of classes, coarsely: eight steps to each doubling; frequent ones come last."""

    def count(rows: list[dict]) -> list[dict]:
        tokens = np.concatenate([unpack_sorted(r["shingles"], r["many"]) for r in rows])
        owners = [np.frombuffer(r["owners"], np.uint16 if len(r["cids"]) < 8 << 16 else np.uint32) for r in rows]
        cids = np.concatenate([np.frombuffer(r["cids"], np.int64)[o] for r, o in zip(rows, owners, strict=True)])
        sizes = np.concatenate([np.frombuffer(r["sizes"], np.uint32)[o] for r, o in zip(rows, owners, strict=True)])
        frequent = np.unique(np.concatenate([np.frombuffer(r["levels"], np.uint64) for r in rows]))
        order = np.argsort(tokens, kind="stable")
        tokens, cids, sizes = tokens[order], cids[order], sizes[order]
        twice = np.zeros(len(tokens) + 1, bool)
        twice[1:-1] = tokens[1:] == tokens[:-1]
        keep = twice[1:] | twice[:-1]
        if len(frequent):
            keep |= np.isin(tokens, frequent)
        tokens, cids, sizes = tokens[keep], cids[keep], sizes[keep]
        order = np.lexsort((cids, tokens))
        tokens, cids, sizes = tokens[order], cids[order], sizes[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (cids[1:] != cids[:-1])
        tokens, cids, sizes = tokens[new], cids[new], sizes[new]
        _, at, df = np.unique(tokens, return_inverse=True, return_counts=True)
        df = np.where(np.isin(tokens, frequent), 0, df[at])
        levels = np.where(df > 0, np.floor(8 * np.log2(np.maximum(df, 1))), FREQUENT_LEVEL).astype(np.uint16)
        keep = df != 1
        return _by_class(PACK, cids[keep], sizes[keep], tokens[keep], levels[keep], buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packs() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kind = batch.column("kind").to_numpy()
                if (kind != PACK).any():
                    passed.append(batch.filter(pa.array(kind != PACK)))
                if (kind == PACK).any():
                    yield batch.filter(pa.array(kind == PACK))

        passed: list[pa.RecordBatch] = []
        for _, rows in groups(packs(), ["bucket"]):
            yield from passed
            passed.clear()
            yield _rows(count(rows))
        yield from passed

    return dealt.repartitionById(buckets, "bucket").sortWithinPartitions(F.desc("kind"), "bucket").mapInArrow(tidy(run), _FIRST)


def _possible(shared: DataFrame, buckets: int, percent: int) -> DataFrame:
    """The classes that can be linked at all: ``cid``, ``n``, ``shingles`` (shared ones, in the global order), ``cuts`` (where
    fragments end) and ``first`` (how many of the shingles must hold a match)."""
    names = ["cid", "n", "shingles", "cuts", "first"]
    limits = [int(np.floor(8 * np.log2(c))) for c in CUTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, ["bucket"]):
            cids = np.concatenate([unsqueeze(r["cids"], np.int64) for r in rows])
            sizes = np.concatenate([unsqueeze(r["sizes"], np.uint32) for r in rows]).astype(np.int64)
            tokens = np.concatenate([np.frombuffer(r["shingles"], np.uint64) for r in rows])
            levels = np.concatenate([unsqueeze(r["levels"], np.uint16) for r in rows])
            order = np.lexsort((tokens, levels, cids))
            order = order[np.r_[True, (cids[order][1:] != cids[order][:-1]) | (tokens[order][1:] != tokens[order][:-1])]]  # equal sets of several packs
            cids, sizes, tokens, levels = cids[order], sizes[order], tokens[order], levels[order]
            edges = np.flatnonzero(np.r_[True, cids[1:] != cids[:-1], True])
            out = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                n = int(sizes[a])
                first = n - -(-percent * n // 100) + 1 - (n - (b - a))
                if first > 0:
                    out.append((int(cids[a]), n, tokens[a:b].view(np.int64), np.searchsorted(levels[a:b], limits).tolist(), min(first, b - a)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32()))], names)

    return shared.repartitionById(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(run), "cid long, n long, shingles array<long>, cuts array<int>, first int")


def _linked(queries: DataFrame, members: DataFrame, possible: DataFrame, percent: int, buckets: int) -> DataFrame:
    """The links ``a``, ``b`` between ``queries`` (``g``, ``cid``) and ``members`` of the same group, both without repeats.

    A group is cut into cells of some hundred queries by as many members. Overlaps are counted by cell and fragment, a small
    table of numbers each, and these tables are added by cell. So a pair is never a row unless it is a link."""
    sizes = queries.groupBy("g").agg(F.count("*").alias("q")).join(members.groupBy("g").agg(F.count("*").alias("m")), "g")
    # Written out, as Spark splits a skewed join only where both sides come right from a shuffle.
    sizes = checkpointed(sizes.select("g", F.ceil(F.col("q") / CELL).cast("int").alias("q"), F.ceil(F.col("m") / CELL).cast("int").alias("m")))

    # Cells are numbered from a random start for each group, so that those of a large group go to all tasks in turn.
    number = F.pmod(F.xxhash64("g"), F.lit(buckets)).cast("int") + F.pmod(F.col("q_part").cast("long") * F.col("m") + F.col("m_part"), F.lit(buckets)).cast("int")

    def cells(side: DataFrame, own: str, other: str) -> DataFrame:
        rows = side.join(sizes, "g").withColumn(f"{own}_part", F.pmod(F.xxhash64("cid"), F.col(own)).cast("int"))
        return rows.withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).select("g", "q_part", "m_part", number.alias("cell"), F.lit(own).alias("side"), "cid")

    both = cells(queries, "q", "m").unionByName(cells(members, "m", "q")).join(possible.select("cid", "n", "shingles", "cuts"), "cid")
    ends = F.concat(F.array(F.lit(0)), "cuts", F.array(F.size("shingles")))
    fragments = F.transform(F.sequence(F.lit(0), F.lit(len(CUTS))), lambda k: F.struct(k.alias("fragment"), F.slice("shingles", F.get(ends, k) + 1, F.get(ends, k + 1) - F.get(ends, k)).alias("part")))
    cell = ["g", "q_part", "m_part", "cell"]
    cut = both.select(*cell, "side", "cid", "n", F.explode(fragments).alias("f")).select(*cell, "side", "cid", "n", "f.fragment", "f.part")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in groups(batches, [*cell, "fragment"]):
            q, m = (sorted((r for r in rows if r["side"] == s), key=lambda r: r["cid"]) for s in "qm")
            held: dict[int, list[int]] = {}
            for j, r in enumerate(m):
                for t in r["part"]:
                    held.setdefault(t, []).append(j)
            table = np.zeros((len(q), len(m)), np.uint32)
            for i, r in enumerate(q):
                met = [held[t] for t in r["part"] if t in held]
                if met:
                    table[i] = np.bincount(np.concatenate(met), minlength=len(m))
            ids = [np.array([r[c] for r in side], np.int64).tobytes() for side in (q, m) for c in ("cid", "n")]
            yield pa.RecordBatch.from_pylist([dict(zip([*cell, "q_ids", "q_n", "m_ids", "m_n", "overlaps"], [*key[:4], *ids, squeeze(table)], strict=True))], schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, cell):
            q, qn, m, mn = (np.frombuffer(rows[0][c], np.int64) for c in ("q_ids", "q_n", "m_ids", "m_n"))
            both = sum(unsqueeze(r["overlaps"], np.uint32).astype(np.int64) for r in rows).reshape(len(q), len(m))
            i, j = np.nonzero((100 * both >= percent * (qn[:, None] + mn[None, :] - both)) & (q[:, None] != m[None, :]))
            yield pa.RecordBatch.from_arrays([pa.array(q[i]), pa.array(m[j])], ["a", "b"])

    schema = pa.schema([("g", pa.int64()), ("q_part", pa.int32()), ("m_part", pa.int32()), ("cell", pa.int32()), *((c, pa.binary()) for c in ("q_ids", "q_n", "m_ids", "m_n", "overlaps"))])
    spread = F.col("cell") + F.col("fragment") * F.lit(max(1, buckets // (len(CUTS) + 1)))
    counted = cut.repartitionById(buckets, spread).sortWithinPartitions(*cell, "fragment").mapInArrow(tidy(count), "g long, q_part int, m_part int, cell int, q_ids binary, q_n binary, m_ids binary, m_n binary, overlaps binary")
    return counted.repartitionById(buckets, "cell").sortWithinPartitions(*cell).mapInArrow(tidy(add), "a long, b long")


def class_components(shared: DataFrame, percent: int, buckets: int) -> DataFrame:
    """``cid`` and ``component`` (a class of it) of each class that is linked with another one, from the packs of ``_shared``.

    Small sides of joins by shingle and by component are written out first, so that Spark can split what a frequent shingle or
    a large component brings to one task."""
    possible = checkpointed(_possible(shared, buckets, percent))
    entries = possible.select("cid", F.explode(F.slice("shingles", F.lit(1), F.col("first"))).alias("shingle"))

    first = checkpointed(entries.groupBy("shingle").agg(F.min("cid").alias("g"), F.count("*").alias("many")).where("many > 1").select("shingle", "g"))
    queries = checkpointed(entries.join(first, "shingle").where("cid <> g").select("g", "cid").distinct())
    links = _linked(queries, queries.select("g", F.col("g").alias("cid")).distinct(), possible, percent, buckets)
    found = checkpointed(components(links.distinct()))

    sizes = checkpointed(found.groupBy("component").agg(F.count("*").alias("size")))
    placed = possible.select("cid").join(found, F.col("cid") == F.col("node"), "left").join(sizes, "component", "left")
    placed = checkpointed(placed.select("cid", F.coalesce("component", "cid").alias("component"), F.coalesce("size", F.lit(1)).alias("size")))
    entries = entries.join(placed, "cid")
    largest = entries.groupBy("shingle").agg(F.max(F.struct("size", "component")).alias("l"), F.min("component").alias("x"), F.max("component").alias("y"))
    open_ = checkpointed(largest.where("x <> y").select("shingle", F.col("l.component").alias("g")))
    outside = checkpointed(entries.join(open_, "shingle").where("component <> g").select("g", "cid").distinct())
    asked = checkpointed(outside.select("g").distinct())
    inside = placed.select(F.col("component").alias("g"), "cid").join(asked, "g", "left_semi")
    more = _linked(outside, inside.unionByName(outside), possible, percent, buckets)
    owner = placed.select("cid", "component")
    between = more.join(owner.toDF("a", "ca"), "a").join(owner.toDF("b", "cb"), "b").where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    merged = checkpointed(components(between)).toDF("component", "merged")
    return owner.join(merged, "component", "left").select("cid", F.coalesce("merged", "component").alias("component"))


def _judged(docs: DataFrame, percent: int) -> DataFrame:
    """``doc_id``, ``mark`` (of the text), ``n`` (size of the set), ``component_id`` and ``owner`` (the component's name) of every row."""
    buckets = buckets_for(docs, BUCKET_BYTES)
    first = checkpointed(_shared(_dealt(docs, buckets), buckets))
    rows = first.where(F.col("kind") == RECORD).select("doc_id", "mark", "n", "cid")
    linked = class_components(first.where(F.col("kind") != RECORD), percent, buckets)
    named = rows.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("least")).join(linked, "cid", "left")
    named = checkpointed(named.select("cid", "least", F.coalesce("component", "cid").alias("owner")))
    least = checkpointed(named.groupBy("owner").agg(F.min("least").alias("component_id")))
    by_class = named.join(least, "owner").select("cid", "owner", "component_id")
    out = rows.where("n > 0").join(by_class, "cid").select("doc_id", "mark", "n", "component_id", "owner")
    return out.unionByName(rows.where("n = 0").select("doc_id", "mark", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("owner")))


def near_duplicates(docs: DataFrame, percent: int = LEAST_PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row."""
    return _judged(docs, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, percent: int = LEAST_PERCENT) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (of several rows of that id, that of the smallest hash of
    its text; of equal ones, any), with all columns, whatever their names. Rows without an id or without words stay.

    Rows are known by id and hash of the text. While the rows that go are few, they are broadcast and no text is moved."""
    row = free_name(docs, "_judged")
    judged = checkpointed(_judged(docs, percent).where("doc_id IS NOT NULL AND n > 0"))
    keys = judged.groupBy("component_id", "owner", "doc_id", "mark").agg(F.count("*").alias("many"))
    first = keys.groupBy("component_id", "owner").agg(F.min(F.struct("doc_id", "mark", "many")).alias("f")).select("f.*")
    stay = checkpointed(first.toDF(f"{row}_id", f"{row}_mark", f"{row}_many"))
    known = F.col("doc_id").isNotNull() & (_mark(F.col("text")) == F.col(f"{row}_mark")) & (F.col("doc_id") == F.col(f"{row}_id"))
    gone = keys.select("doc_id", "mark", F.lit(1).alias("any")).distinct().join(stay, (F.col("doc_id") == F.col(f"{row}_id")) & (F.col("mark") == F.col(f"{row}_mark")), "left_anti")
    gone = checkpointed(gone.select(F.col("doc_id").alias(f"{row}_id"), F.col("mark").alias(f"{row}_mark")))
    twice = checkpointed(stay.where(f"{row}_many > 1"))
    out = docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, known, "left_anti")
    if twice.isEmpty():
        return out
    once = out.join(twice, known, "left_anti")
    held = out.join(twice, known, "left_semi").withColumn(row, _mark(F.col("text"))).dropDuplicates(["doc_id", row])
    return once.unionByName(held.drop(row))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END))) AS i FROM docs))),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON b.g = a.g AND b.doc_id <> a.doc_id GROUP BY 1, 2)
  JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
reached AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN (SELECT x, min(y) AS component_id FROM reached GROUP BY x) c ON c.x = d.doc_id
"""
