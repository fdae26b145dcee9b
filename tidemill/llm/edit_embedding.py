"""Operator 1: fingerprints of documents by randomised edit embedding.

A text is copied character by character into a longer string: at each step of a walk the character under the pointer is
written down, and a random bit, shared by all texts and given by the step and the character, says whether the pointer moves
on. Texts of small edit distance fall into step again after each difference, so that edit distance becomes Hamming distance.
The fingerprint is a fixed number of bits, each a random bit of the character that stands at a sampled step. Steps are
sampled alike for all texts: by one rising series of candidates for each bit, of which the last one inside the walk counts,
which makes it equally likely to be any step of the walk and the same one for walks of nearly the same length.

``near_documents`` finds near documents: bits sampled from the fingerprints make bands, fingerprints that share a band meet, and
their whole distance verifies them. ``near_pairs`` tells each such pair.

Defined results: a null text counts as empty; the empty text's fingerprint is all zeros; equal texts have equal
fingerprints; rows without an id come after all others, in the order of their texts' hashes, and rows of one id follow each
other in the order of their texts; the only row of a table is its own next document; an empty table gives no rows; other
columns are ignored. Whole texts are walked, however long."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.blobs import groups
from tidemill.llm.graph import components
from tidemill.llm.tables import checkpointed, partitions, read_table, texts
from tidemill.llm.wordhash import mix

BITS = 256
#: The random bits of the walk repeat after so many steps, and characters fall into so many kinds for them.
STEPS, KINDS = 1 << 12, 64
SEED = 20240611
#: In ``near_pairs`` so many fingerprints of a bucket meet as many at once.
CELL = 512


@lru_cache(maxsize=1)
def _shared() -> tuple[list, np.ndarray, np.ndarray]:
    """The walk as linked nodes (a step's node has, for each kind of character, the node where the pointer has moved on, and
    last its own number), the series of candidate steps of each bit, and each bit's multiplier."""
    random = np.random.default_rng(SEED)
    moves = random.integers(0, 2, (STEPS, KINDS), dtype=np.uint8)
    nodes: list[list] = [[None] * (KINDS + 1) for _ in range(STEPS)]
    for kind in range(KINDS):
        at = np.flatnonzero(np.r_[moves[:, kind], moves[:, kind]])
        after = (at[np.searchsorted(at, np.arange(STEPS))] + 1) % STEPS
        for step, to in enumerate(after.tolist()):
            nodes[step][kind] = nodes[to]
    for step, node in enumerate(nodes):
        node[KINDS] = step
    series = np.zeros((BITS, 96))
    for k in range(1, series.shape[1]):
        series[:, k] = np.minimum(2.0**62, np.floor((series[:, k - 1] + 1) / (1 - random.random(BITS))))
    return nodes, series.astype(np.int64), random.integers(0, 1 << 63, BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _walk(points: np.ndarray, step: int) -> np.ndarray:
    """The step, modulo the period, at which the pointer comes to each character, and the one at which it leaves the last."""
    kinds = ((points * np.uint32(2654435761)) >> np.uint32(26)).astype(np.uint8).tobytes()
    nodes = _shared()[0]
    return np.fromiter(map(itemgetter(KINDS), accumulate(kinds, getitem, initial=nodes[step])), np.uint16, len(kinds) + 1)


def _stays(steps: np.ndarray) -> np.ndarray:
    """How long the pointer stays at each character."""
    stay = np.diff(steps) % STEPS  # 16 bits; the period divides what they wrap at
    stay[stay == 0] = STEPS
    return stay.astype(np.int32)


def _bits(points: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """The sampled bits; ``leaves``: the step at which the pointer leaves each character."""
    if not len(points):
        return np.zeros(BITS, np.uint8)
    _, series, odd = _shared()
    step = series[np.arange(BITS), (series < leaves[-1]).sum(axis=1) - 1]
    return (mix(points[np.searchsorted(leaves, step, "right")] * odd) >> np.uint64(63)).astype(np.uint8)


def fingerprint(text: str) -> str:
    points = _points(text)
    return _hex(_bits(points, np.cumsum(_stays(_walk(points, 0)))))


def _hex(bits: np.ndarray) -> str:
    return np.packbits(bits).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal bits, about 0 for unrelated texts."""
    return max(0.0, 1.0 - 2.0 * float(np.count_nonzero(a != b)) / len(a))


def _in_order(docs: DataFrame, buckets: int) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) dealt to buckets by ranges of the id, or of the text's hash where there is no id, each sorted, the
    first document of the next bucket behind it (``extra``; behind the last one that of the first). Only ids and hashes are
    looked at to find the ranges; what reaches the driver, and goes back as a small table, is a row for each bucket. Texts are
    shuffled once, each bucket to a task of its own."""
    docs = docs.withColumn("hash", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long")))
    quantiles = [k / buckets for k in range(1, buckets)]
    found = docs.select("doc_id").agg(F.count("doc_id").alias("named"), F.count("*").alias("n"), F.percentile_approx("doc_id", quantiles or [0.5], 10 * buckets).alias("cuts")).first()
    cuts = np.unique(np.array(found["cuts"] or [], np.int64))[: buckets - 1]
    unnamed = max(1, round(buckets * (found["n"] - found["named"]) / max(1, found["n"])))  # buckets of rows without an id

    @F.arrow_udf("int")
    def bucket(doc_id: pa.Array, hashed: pa.Array) -> pa.Array:
        at = np.searchsorted(cuts, doc_id.fill_null(0).to_numpy(zero_copy_only=False), "right")
        share = (hashed.to_numpy(zero_copy_only=False).astype(np.float64) + 2.0**63) / 2.0**64
        later = len(cuts) + 1 + np.minimum(unnamed - 1, (share * unnamed).astype(np.int64))
        return pa.array(np.where(doc_id.is_null().to_numpy(zero_copy_only=False), later, at).astype(np.int32))

    dealt = docs.withColumn("to", bucket("doc_id", "hash"))
    first = F.struct(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("hash"))
    heads = sorted((r["to"], *r["least"]) for r in dealt.groupBy("to").agg(F.min(first).alias("least")).collect())
    # A bucket's first document also goes to the bucket before it.
    moved = [(b, i, h, heads[k - 1][0]) for k, (b, i, h) in enumerate(heads)]
    heads = docs.sparkSession.createDataFrame(moved, "to int, least long, hash long, before int")
    same = ["to", F.coalesce("doc_id", F.lit(0)).alias("least"), "hash"]
    met = dealt.select("doc_id", "text", *same).join(F.broadcast(heads), ["to", "least", "hash"], "left")
    copies = F.array(F.struct(F.col("to").alias("to"), F.lit(0).alias("extra")))
    copies = F.when(F.col("before").isNull(), copies).otherwise(F.concat(copies, F.array(F.struct(F.col("before").alias("to"), F.lit(1).alias("extra")))))
    rows = met.select("doc_id", "text", "hash", F.explode(copies).alias("c")).select("doc_id", "text", "hash", "c.to", "c.extra")
    return rows.repartitionById(len(cuts) + 1 + unnamed, "to").sortWithinPartitions("to", "extra", F.asc_nulls_last("doc_id"), "hash", "text")


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every row's fingerprint, and that of its edited text, whose last quarter is replaced by the start of the next document."""

    def told(this: tuple, after: tuple) -> tuple:
        doc_id, text, points, steps, leaves, bits = this
        kept = len(points) - len(points) // 4
        new = np.concatenate([points[:kept], after[2][: len(points) - kept]])
        edited = text[:kept] + after[1][: len(points) - kept]
        # The walk over what was kept is the one already made; from there it goes on over what is new.
        more = _stays(_walk(new[kept:], int(steps[kept])))
        at = leaves[kept - 1] if kept else 0
        edited_bits = _bits(new, np.concatenate([leaves[:kept], at + np.cumsum(more)]))
        sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return doc_id, len(points), sha, _hex(bits), _hex(edited_bits), likeness(bits, edited_bits), likeness(bits, after[5])

    def walked(doc_id, text: str) -> tuple:
        points = _points(text)
        steps = _walk(points, 0)
        leaves = np.cumsum(_stays(steps))
        return doc_id, text, points, steps, leaves, _bits(points, leaves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = held = None
        done = True  # an extra document of this bucket has been met, so that others (of the same id) are passed over
        for batch in batches:
            out = []
            for doc_id, text, to, extra in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("to").to_pylist(), batch.column("extra").to_pylist(), strict=True):
                if to != bucket:
                    bucket, held, done = to, None, False
                if done:
                    continue
                now = walked(doc_id, text.as_py())
                if held is not None:
                    out.append(told(held, now))
                held, done = now, bool(extra)
            if out:
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], NAMES)

    ordered = _in_order(texts(docs), partitions(docs.sparkSession))
    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _picks(bands: int, band_bits: int) -> list[list[int]]:
    """The bits of each band, sampled alike for all."""
    random = np.random.default_rng(SEED + 1)
    return [sorted(random.choice(BITS, band_bits, replace=False).tolist()) for _ in range(bands)]


def near_pairs(prints: DataFrame, least: float = 0.75, bands: int = 32, band_bits: int = 16) -> DataFrame:
    """``fingerprint``, ``near`` (a smaller fingerprint at least so like it, 0 to 1) and ``likeness``, once for each pair that
    shares a band, from the column ``fingerprint``.

    Equal fingerprints are one class. Each band is some bits of the fingerprint; in a band's bucket all classes are compared
    with each other. A bucket is cut into parts of about ``CELL`` classes and two parts meet in a cell, so that a task holds
    little at once, but a bucket's comparisons are the square of its size. A pair is told by the first band it shares."""
    picks = _picks(bands, band_bits)
    digits = F.split(_binary(F.col("fingerprint")), "")
    keyed = prints.select("fingerprint").distinct().select("fingerprint", digits.alias("d"))
    keys = F.array(*(F.concat_ws("", F.lit(f"{k}:"), *(F.get("d", i) for i in pick)) for k, pick in enumerate(picks)))
    banded = keyed.select("fingerprint", F.explode(keys).alias("band"))
    parts = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band", F.ceil(F.col("n") / CELL).cast("int").alias("parts"))
    placed = banded.join(parts, "band").withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = ["band", "low", "high"]
    cells = met.select("band", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "fingerprint")
    masks = np.zeros((bands, BITS // 64), np.uint64)
    for k, pick in enumerate(picks):
        for i in pick:
            masks[k, i // 64] |= np.uint64(1 << 63 - i % 64)

    def numbers(hexed: list[str]) -> np.ndarray:
        return np.frombuffer(bytes.fromhex("".join(hexed)), ">u8").astype(np.uint64).reshape(-1, BITS // 64)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (band, low, high), rows in groups(batches, cell):
            sides = [[r["fingerprint"] for r in rows if r["part"] == p] for p in (low, high)]
            a, b = (numbers(side) for side in sides)
            apart = sum(np.bitwise_count(a[:, None, w] ^ b[None, :, w]).astype(np.int64) for w in range(BITS // 64))
            alike = 1 - 2 * apart / BITS
            found = alike >= least
            i, j = np.nonzero(np.tril(found, -1) if low == high else found)
            known = np.zeros(len(i), bool)
            for mask in masks[: int(band.split(":")[0])]:
                known |= ((a[i] ^ b[j]) & mask == 0).all(axis=1)
            i, j = i[~known], j[~known]
            pairs = [sorted((sides[0][x], sides[1][y])) for x, y in zip(i.tolist(), j.tolist(), strict=True)]
            columns = [pa.array([p[1] for p in pairs], pa.string()), pa.array([p[0] for p in pairs], pa.string()), pa.array(alike[i, j], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["fingerprint", "near", "likeness"])

    dealt = cells.repartition(partitions(prints.sparkSession), *cell).sortWithinPartitions(*cell)
    return dealt.mapInArrow(compare, "fingerprint string, near string, likeness double")


#: In ``near_documents`` a band has so many bits that a bucket holds about this many unrelated fingerprints, whatever the corpus,
#: and there are so many bands that this share of the pairs at the limit of likeness meets in one.
UNRELATED, RECALL = 32, 0.97
#: A bucket of more fingerprints than this is cut into parts, whose leaders meet in a second round, two parts of about ``CROSS`` in a
#: cell, so that no task has a whole bucket.
BUCKET, CROSS = 50_000, 4_096
#: Bands of fingerprints that one task is dealt, at most, however few partitions the session has.
DEALT = 4_000_000


def bands_for(classes: int, least: float) -> tuple[int, int]:
    """How many bands, and of how many bits, for so many different fingerprints."""
    bits = min(40, max(8, (classes // UNRELATED).bit_length()))
    met = (1 - (1 - least) / 2) ** bits
    return int(np.ceil(np.log(1 - RECALL) / np.log1p(-met))), bits


def leaders(prints: np.ndarray, ids: np.ndarray, least: float) -> np.ndarray:
    """For each fingerprint of a bucket (rows of 64-bit numbers, in the order of ``ids``) the place of the first one that is near it, or its
    own. One after the other leads those that have no leader yet, so that copies of one text cost a comparison each."""
    leader, free = np.arange(len(ids)), np.arange(len(ids))
    most = BITS * (1 - least) / 2
    while len(free) > 1:
        first, rest = free[0], free[1:]
        near = np.bitwise_count(prints[rest] ^ prints[first]).sum(axis=1, dtype=np.int64) <= most
        leader[rest[near]] = first
        free = rest[~near]
    return leader


def first_near(prints: np.ndarray, among: np.ndarray, least: float) -> np.ndarray:
    """For each fingerprint the place of the first one of ``among`` that is near it, or -1."""
    found, free = np.full(len(prints), -1), np.arange(len(prints))
    most = BITS * (1 - least) / 2
    for k, one in enumerate(among):
        near = np.bitwise_count(prints[free] ^ one).sum(axis=1, dtype=np.int64) <= most
        found[free[near]] = k
        free = free[~near]
        if not len(free):
            break
    return found


def near_documents(docs: DataFrame, least: float = 0.75) -> DataFrame:
    """``doc_id``, ``near_id`` of every row: the smallest id of the documents that links between fingerprints at least so like reach,
    its own included; of rows without an id, null if they reach none that has one.

    Equal fingerprints are one class. In the bucket of a band each class is linked with the first one that is near it, so that
    a group of copies makes a star and never all its pairs. A bucket that is too large for a task is cut into parts, and what
    leads in a part meets the other parts' leaders, in cells of bounded size: each leader is sent to as many cells as there are parts."""
    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [_hex(_bits(p, np.cumsum(_stays(_walk(p, 0))))) for p in map(_points, batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([bytes.fromhex(p) for p in prints], pa.binary())], ["doc_id", "print"])

    prints = checkpointed(texts(docs).mapInArrow(walked, "doc_id long, print binary"))
    classes = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    classes = checkpointed(classes.select("print", F.xxhash64("print").alias("node"), "least"))
    many = classes.count()
    bands, bits = bands_for(many, least)
    n = max(partitions(docs.sparkSession), -(-many * bands // DEALT))
    picks = np.array(_picks(bands, bits))
    weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                found = np.unpackbits(np.frombuffer(b"".join(batch.column("print").to_pylist()), np.uint8).reshape(-1, BITS // 8), axis=1).astype(np.uint64)
                keys = ((found[:, picks] * weights).sum(axis=2, dtype=np.uint64) * np.uint64(bands) + np.arange(bands, dtype=np.uint64)).astype(np.int64)
                at = np.repeat(np.arange(batch.num_rows), bands)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *(batch.column(c).take(pa.array(at)) for c in ("print", "node", "least"))], ["band", "print", "node", "least"])

    def led(rows: DataFrame, *by: str) -> DataFrame:
        """``node``, ``to`` (its leader in the bucket) of all rows, and the leaders' ``band``, ``print``, ``least``."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, held in groups(batches, [*by]):
                numbers = np.frombuffer(b"".join(r["print"] for r in held), np.uint64).reshape(-1, BITS // 64)
                nodes = np.array([r["node"] for r in held], np.int64)
                place = leaders(numbers, nodes, least)
                leads = place == np.arange(len(place))
                columns = [pa.array(nodes), pa.array(nodes[place]), pa.array([r["band"] for r in held], pa.int64()), pa.array([r["print"] if x else None for r, x in zip(held, leads, strict=True)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "to", "band", "print"])

        dealt = rows.repartition(n, *by).sortWithinPartitions(*by, "node")
        return dealt.mapInArrow(run, "node long, to long, band long, print binary")

    def crossed(rows: DataFrame) -> DataFrame:
        """``node``, ``to`` (the first one that is near it) in each cell of the leaders of large buckets."""
        cell = ["band", "low", "high"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (_, low, high), held in groups(batches, cell):
                sides = [[r for r in held if r["part"] == p] for p in (low, high)]
                a, b = (np.frombuffer(b"".join(r["print"] for r in side), np.uint64).reshape(-1, BITS // 64) for side in sides)
                a_nodes, b_nodes = (np.array([r["node"] for r in side], np.int64) for side in sides)
                place = leaders(b, b_nodes, least) if low == high else first_near(b, a, least)
                linked = place != np.arange(len(place)) if low == high else place >= 0
                yield pa.RecordBatch.from_arrays([pa.array(b_nodes[linked]), pa.array(a_nodes[place[linked]])], ["node", "to"])

        sizes = checkpointed(rows.groupBy("band").agg(F.ceil(F.count("*") / CROSS).cast("int").alias("parts")))
        placed = rows.join(sizes, "band").withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int"))
        met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        cells = met.select("band", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "print", "node")
        return cells.repartition(n, *cell).sortWithinPartitions(*cell, "node").mapInArrow(run, "node long, to long")

    spread = classes.mapInArrow(banded, "band long, print binary, node long, least long").select("band", "print", "node")
    held = spread.select("band").groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    large = checkpointed(held.where(F.col("n") > BUCKET).select("band", F.ceil(F.col("n") / BUCKET).cast("int").alias("parts")))
    if large.isEmpty():
        links = led(spread.withColumn("part", F.lit(0)), "band", "part").where("node <> to").select("node", "to")
    else:
        parted = spread.join(large, "band", "left").withColumn("part", F.pmod(F.col("node"), F.coalesce("parts", F.lit(1))).cast("int"))
        first = checkpointed(led(parted.select("band", "part", "print", "node"), "band", "part"))
        again = crossed(first.where("print IS NOT NULL").join(large, "band", "left_semi").select("band", "print", "node"))
        links = first.where("node <> to").select("node", "to").unionByName(again)
    found = checkpointed(components(links.distinct().toDF("a", "b")))
    placed = classes.join(found, "node", "left").select("print", "least", F.coalesce("component", "node").alias("component"))
    placed = checkpointed(placed)
    smallest = checkpointed(placed.groupBy("component").agg(F.min("least").alias("near_id")))
    by_print = placed.join(smallest, "component").select("print", "near_id")
    return prints.join(by_print, "print").select("doc_id", "near_id")


def _binary(hexed):
    """A hexadecimal string as a string of binary digits."""
    return F.array_join(F.transform(F.filter(F.split(hexed, ""), lambda c: c != ""), lambda c: F.lpad(F.conv(c, 16, 2), 4, "0")), "")


def near_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Banding and verification over all documents: each document's group of near ones."""
    return near_documents(read_table(spark, sf_dir, "documents"))


def op1_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))
