"""Operator 11: the best documents for each query, ranked by words, by Block-Max MaxScore.

Documents are indexed in shards of bounded size. A shard keeps, for each word that some query has, the documents that hold it
in blocks of ``BLOCK``; a block is packed bytes and, beside it, its competitive pairs of occurrences and document length, which
give the block's exact maximum once the corpus counts are known. Those counts (documents, words, documents of each word) are
sums over the shards. Then each shard answers all queries: the lists' maxima part them into essential ones, which bring
candidates, and the others, whose blocks' maxima reject candidates before the blocks are unpacked. The shards' best are merged.

Queries are taken in blocks of a bounded number of words, and each block's words go to all tasks. Words are told by hashes of
64 bits and their length: among 10^10 different words and 10^6 of queries, one in a thousand corpora would have a false one.

Defined results: null and empty texts have no words, count for nothing and are found by nothing; a query without words finds
nothing; rows of one ``item_id`` are one query of all their words, once each, and so are rows without one; repeated documents are ranked each;
documents without an id come after the others of equal score; other columns are ignored; empty tables give no rows."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.blobs import tidy
from tidemill.llm.native import words as words_of
from tidemill.llm.tables import checkpointed, read_table, texts
from tidemill.llm.wordhash import LOWER, blocks, word_hashes, words

BEST = 10
#: Postings in a block; documents in a step of the search, from the first step on; postings or documents that close a shard.
BLOCK, FIRST_STEP, STEP = 128, 256, 4096
SHARD_POSTINGS, SHARD_DOCS = 2_000_000, 100_000
#: How many words the queries of a block have together, about.
QUERY_WORDS = 1_000_000

IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
WIDTHS = (np.uint8, np.uint16, np.uint32)


class Words:
    """The words of the queries: their hashes in rising order, and the place of a word in that order."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        starts = ends - np.array([len(r) for r in raw], np.int64)
        hashes = word_hashes(np.frombuffer(b"".join(raw), np.uint8), starts, ends) if raw else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.lengths = hashes[order], (ends - starts)[order]
        self.place = {terms[k]: i for i, k in enumerate(order)}

    def counts(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """How many words each text has; then (text, word of the queries, occurrences), rising."""
        low = LOWER[raw]
        starts, ends, firsts = words(low, offsets, IS_WORD)
        many = np.diff(firsts)
        if not len(starts) or not len(self.hashes):
            return many, *(np.zeros(0, np.int64) for _ in range(3))
        hashes = word_hashes(low, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = (self.hashes[at] == hashes) & (self.lengths[at] == ends - starts)
        text = np.repeat(np.arange(len(many)), many)[known]
        keys, n = np.unique(text * len(self.hashes) + at[known], return_counts=True)
        return many, keys // len(self.hashes), keys % len(self.hashes), n


def packed_index(ids: np.ndarray, lengths: np.ndarray, term: np.ndarray, doc: np.ndarray, tf: np.ndarray) -> bytes:
    """A shard: postings by word and document, in packed blocks, with the competitive (occurrences, length) pairs of each block."""
    order = np.lexsort((doc, term))
    term, doc, tf = term[order], doc[order], tf[order]
    listed, list_start = np.unique(term, return_index=True)
    in_list = np.arange(len(term)) - np.repeat(list_start, np.diff(np.r_[list_start, len(term)]))
    start = np.flatnonzero(in_list % BLOCK == 0)
    end = np.r_[start[1:], len(term)][: len(start)]
    steps = np.diff(doc, prepend=0)
    steps[start] = 0
    widths = [np.digitize(np.maximum.reduceat(x, start), [1 << 8, 1 << 16]) if len(start) else np.zeros(0, np.int64) for x in (steps, tf)]
    packs, offset = [], [0]
    for a, z, step_width, tf_width in zip(start, end, *widths, strict=True):
        packs.append(steps[a:z].astype(WIDTHS[step_width]).tobytes() + tf[a:z].astype(WIDTHS[tf_width]).tobytes())
        offset.append(offset[-1] + len(packs[-1]))
    of_block = np.repeat(np.arange(len(start)), end - start)
    by = np.lexsort((lengths[doc], -tf, of_block))
    # A pair counts if it is shorter than all of its block with as many occurrences or more.
    rank = lengths[doc][by] - of_block[by] * (int(lengths.max(initial=0)) + 1)
    keep = np.r_[True, rank[1:] < np.minimum.accumulate(rank)[:-1]] if len(by) else np.zeros(0, bool)
    best = by[keep]
    return pickle.dumps(
        {
            "ids": ids, "lengths": lengths, "listed": listed, "list_block": np.searchsorted(start, list_start), "start": start, "end": end, "first": doc[start], "last": doc[end - 1],
            "widths": np.stack(widths), "offset": np.array(offset), "bytes": b"".join(packs), "pair_block": of_block[best], "pair_tf": tf[best], "pair_length": lengths[doc[best]],
        }
    )


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What an occurrence count is worth in a document of measure ``m``, before the word's weight; 64-bit whole numbers."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Shard:
    """A shard's lists for searching. Blocks are unpacked when a search needs them, and stay so for the shard's other queries."""

    def __init__(self, data: bytes, documents: int, total: int):
        self.x = x = pickle.loads(data)
        self.documents, self.total = documents, total
        self.m = self.measure(x["lengths"])
        pairs = impact(x["pair_tf"], self.measure(x["pair_length"]))
        first = np.searchsorted(x["pair_block"], np.arange(len(x["start"])))
        self.block_most = np.maximum.reduceat(pairs, first) if len(first) else np.zeros(0, np.int64)
        self.most = np.maximum.reduceat(self.block_most, x["list_block"]) if len(x["listed"]) else np.zeros(0, np.int64)
        # Until a block is unpacked its last document stands for all of it, so that the lists stay sorted.
        self.docs = np.repeat(x["last"], x["end"] - x["start"])
        self.worth = np.zeros(len(self.docs), np.int64)
        self.open = np.zeros(len(x["start"]), bool)
        self.unpacked = 0

    def measure(self, lengths: np.ndarray) -> np.ndarray:
        return 10 + (90 * lengths.astype(np.int64) * self.documents) // self.total

    def unpack(self, block_numbers: np.ndarray) -> None:
        x = self.x
        for b in block_numbers[~self.open[block_numbers]]:
            a, z, at = x["start"][b], x["end"][b], x["offset"][b]
            steps, tf = (WIDTHS[w] for w in x["widths"][:, b])
            docs = x["first"][b] + np.cumsum(np.frombuffer(x["bytes"], steps, z - a, at), dtype=np.int64)
            self.docs[a:z] = docs
            self.worth[a:z] = impact(np.frombuffer(x["bytes"], tf, z - a, at + (z - a) * np.dtype(steps).itemsize), self.m[docs])
            self.open[b] = True
            self.unpacked += 1

    def blocks_of(self, at: int) -> tuple[int, int]:
        starts = self.x["list_block"]
        return int(starts[at]), int(starts[at + 1]) if at + 1 < len(starts) else len(self.open)

    def search(self, query: dict[int, int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The shard's ``k`` best documents for words with weights, and their scores; of equal scores the smaller ids."""
        listed = self.x["listed"]
        found = [(w * int(self.most[at]), w, at) for t, w in query.items() if w > 0 and (at := int(np.searchsorted(listed, t))) < len(listed) and listed[at] == t]
        found.sort()
        bounds = np.cumsum([u for u, _, _ in found], dtype=np.int64)
        best, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1  # a score must be above 0
        a, size = 0, FIRST_STEP
        while found and a < len(self.m):
            z = min(len(self.m), a + size)
            essential = int(np.searchsorted(bounds, least))  # what only lists before it hold stays below ``least``
            if essential == len(found):
                break
            score = np.zeros(z - a, np.int64)
            for _, w, at in found[essential:]:
                self._add(score, w, at, a, z)
            candidates = np.flatnonzero(score)
            for i in range(essential - 1, -1, -1):
                if not len(candidates):
                    break
                candidates = self._refine(score, candidates, found[i][1], found[i][2], a, least, int(bounds[i - 1]) if i else 0)
            candidates = candidates[score[candidates] >= least]
            if len(candidates):
                best, scores = np.r_[best, candidates + a], np.r_[scores, score[candidates]]
                ids, missing = self.x["ids"]
                kept = np.lexsort((ids[best], missing[best], -scores))[:k]
                best, scores = best[kept], scores[kept]
                if len(best) == k:
                    least = int(scores[-1])
            a, size = z, min(STEP, 2 * size)
        return best, scores

    def _add(self, score: np.ndarray, w: int, at: int, a: int, z: int) -> None:
        """An essential list's part of the documents from ``a`` to before ``z``."""
        low, high = self.blocks_of(at)
        first = low + int(np.searchsorted(self.x["last"][low:high], a))
        end = low + int(np.searchsorted(self.x["first"][low:high], z))
        if first >= end:
            return
        self.unpack(np.arange(first, end))
        s, e = self.x["start"][first], self.x["end"][end - 1]
        s, e = s + np.searchsorted(self.docs[s:e], [a, z])
        score[self.docs[s:e] - a] += w * self.worth[s:e]

    def _refine(self, score: np.ndarray, candidates: np.ndarray, w: int, at: int, a: int, least: int, rest: int) -> np.ndarray:
        """The candidates that can still reach ``least`` with a non-essential list, its part added. A block is unpacked only if its maximum
        leaves one of its candidates in."""
        low, high = self.blocks_of(at)
        docs = candidates + a
        block = low + np.searchsorted(self.x["last"][low:high], docs)
        inside = block < high
        inside[inside] = self.x["first"][block[inside]] <= docs[inside]
        bound = np.zeros(len(docs), np.int64)
        bound[inside] = w * self.block_most[block[inside]]
        stays = score[candidates] + bound + rest >= least
        candidates, inside, block = candidates[stays], inside[stays], block[stays]
        if inside.any():
            self.unpack(np.unique(block[inside]))
            s, e = self.x["start"][low], self.x["end"][high - 1]
            docs = candidates[inside] + a
            place = s + np.searchsorted(self.docs[s:e], docs)
            held = self.docs[place] == docs
            score[docs[held] - a] += w * self.worth[place[held]]
        return candidates


def shards(docs: DataFrame, terms: list[str]) -> DataFrame:
    """One row a shard: ``documents`` (with words), ``words``, ``held`` (a word's place and its documents) and ``index``."""
    shared = docs.sparkSession.sparkContext.broadcast(Words(terms))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n_docs, n_postings = [], 0, 0

        def closed() -> pa.RecordBatch:
            ids, missing, lengths, doc, term, tf = (np.concatenate(p) for p in zip(*parts, strict=True))
            listed, n = np.unique(term, return_counts=True)
            held = [{"word": int(t), "n": int(c)} for t, c in zip(listed, n, strict=True)]
            row = {"documents": int((lengths > 0).sum()), "words": int(lengths.sum()), "held": held, "index": packed_index((ids, missing), lengths, term, doc, tf)}
            return pa.RecordBatch.from_pylist([row], pa.schema([("documents", pa.int64()), ("words", pa.int64()), ("held", pa.list_(pa.struct([("word", pa.int32()), ("n", pa.int64())]))), ("index", pa.binary())]))

        for batch in batches:
            column = batch.column("doc_id")
            ids, missing = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), column.is_null().to_numpy(zero_copy_only=False)
            for first, raw, offsets in blocks(batch.column("text")):
                lengths, doc, term, tf = shared.value.counts(raw, offsets)
                last = first + len(lengths)
                parts.append((ids[first:last], missing[first:last], lengths, doc + n_docs, term, tf))
                n_docs, n_postings = n_docs + len(lengths), n_postings + len(tf)
                if n_docs >= SHARD_DOCS or n_postings >= SHARD_POSTINGS:
                    yield closed()
                    parts, n_docs, n_postings = [], 0, 0
        if parts:
            yield closed()

    return texts(docs).mapInArrow(tidy(build), "documents long, words long, held array<struct<word: int, n: long>>, index binary")


def _answered(docs: DataFrame, queries: list[tuple[int | None, list[str]]], k: int) -> DataFrame:
    """Each shard's best for a block of queries: ``item_id``, ``doc_id``, ``score``."""
    spark = docs.sparkSession
    terms = sorted({t for _, own in queries for t in own})
    index = checkpointed(shards(docs, terms))
    documents, total = index.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    # A number for each word of the block of queries.
    held = dict(index.select(F.explode("held").alias("h")).groupBy("h.word").agg(F.sum("h.n")).collect())
    place = Words(terms).place
    weight = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * held.get(place[t], 0) + 1))) for t in terms}
    shared = spark.sparkContext.broadcast([(i, {place[t]: weight[t] for t in own}) for i, own in queries])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("index"):
                shard = Shard(data.as_py(), documents, max(1, total))
                ids, missing = shard.x["ids"]
                items, docs, scores = [], [], []
                for item, query in shared.value:
                    best, score = shard.search(query, k)
                    items += [item] * len(best)
                    docs += [None if missing[d] else int(ids[d]) for d in best]
                    scores.append(score)
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(docs, pa.int64()), pa.array(np.concatenate(scores or [np.zeros(0, np.int64)]), pa.int64())], ["item_id", "doc_id", "score"])

    return index.select("index").mapInArrow(tidy(search), "item_id long, doc_id long, score long")


def ranked(docs: DataFrame, queries: DataFrame, k: int = BEST) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents for the text of each item of ``queries``.

    A block of queries is bounded in words and read by the driver; documents are indexed once for each block."""
    asked = queries.select("item_id", F.explode(words_of(F.coalesce("text", F.lit("")))).alias("word")).distinct()
    n = asked.count()
    parts = -(-n // QUERY_WORDS)
    found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    for part in range(parts):
        some = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).groupBy("item_id").agg(F.sort_array(F.collect_list("word")).alias("words"))
        found = found.unionByName(_answered(docs, [(r["item_id"], r["words"]) for r in some.collect()], k))
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_TERMS = r"SELECT {key}, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word FROM {table}"
OP11_SQL = f"""
WITH words AS ({_TERMS.format(key="doc_id", table="documents")}),
tfs AS (SELECT doc_id, word, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
asked AS (SELECT DISTINCT * FROM ({_TERMS.format(key="item_id", table="benchmark")})),
weights AS (SELECT word, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT word, count(*) AS df FROM tfs GROUP BY word), corpus),
measured AS (SELECT doc_id, 10 + (90 * n * docs) // total AS m FROM lengths, corpus),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM asked JOIN weights USING (word) JOIN tfs USING (word) JOIN measured USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
