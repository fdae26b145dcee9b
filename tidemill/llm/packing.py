"""Operator 7: packing documents into fixed-length token sequences, best fit decreasing.

Overlong documents are first cut into full windows; what is left of each is one piece shorter than a window. Longest first,
each piece goes to the open window with the least room that still holds it, found in a segment tree indexed by remaining
room, or opens a new one.

A piece is no more than its length to that rule, so the rule runs over the count of pieces of each length (as many numbers
as a window has places, whatever the corpus) and treats equal windows together. What it returns is a short plan: pieces of
this length, from this rank on, go to these sequences at this offset. Executors rank their pieces and look their places up.

Defined results: null and empty texts are one piece, the end token alone; repeated rows are pieces each; an empty table
gives no rows; other columns are ignored; documents of any length are tokenised whole."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.tables import checkpointed, read_table, texts

WINDOW, END = 2048, 1
#: Pieces of one length are ranked in parts, so that a length that many documents share (a full window is one) is no single
#: task: about so many parts in all, or fewer where they would have less than so many rows.
PARTS, LEAST_ROWS = 20_000, 500
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_RUN = re.compile(r"\s{100000}")


@lru_cache(maxsize=2)
def _whole(path: str):
    """The tokenizer that the file describes."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _bytes_of_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: visible ones stand for themselves, others for the letters from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def splits_as_pattern(path: str) -> bool:
    """Whether the file cuts texts as ``PATTERN`` does and merges bytes within the cuts: a plain byte-level vocabulary, without a
    normalizer, an unknown token, dropout or affixes."""
    told = json.loads(Path(path).read_text(encoding="utf-8"))
    cut, model = told.get("pre_tokenizer") or {}, told["model"]
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
    affixes = ("unk_token", "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")
    return plain and told.get("normalizer") is None and model.get("type") == "BPE" and not any(model.get(k) for k in affixes)


@lru_cache(maxsize=2)
def _encoding(path: str):
    """The vocabulary of the file in a library that merges faster. A piece's id is its rank there, which is what this asks for."""
    import tiktoken

    told = json.loads(Path(path).read_text(encoding="utf-8"))
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    letters = _bytes_of_letters()
    ranks = {bytes(letters[c] for c in piece): i for piece, i in told["model"]["vocab"].items() if piece not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(text: str, path: str) -> list[int]:
    """The ids of a text. In a run of about a million whitespace characters the fast library's pattern gives up, so texts with
    runs of a tenth of that go to the other one, and so does every text where the file cuts otherwise than the pattern."""
    if not splits_as_pattern(path) or LONG_RUN.search(text):
        return _whole(path).encode(text, add_special_tokens=False).ids
    return _encoding(path).encode(text, allowed_special="all")


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """Each document's pieces: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.array([*token_ids(text.as_py(), path), end], "<u4")
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    for values, x in zip(rows, (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)), strict=True):
                        values.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], names)

    return texts(docs).mapInArrow(cut, ", ".join(f"{n} long" for n in names))


class Rooms:
    """A segment tree over remaining room: which is the least room of at least so much that some open window has?"""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.count = [0] * (2 * self.width)

    def add(self, room: int, n: int) -> None:
        k = room + self.width
        while k:
            self.count[k] += n
            k //= 2

    def least(self, room: int) -> int | None:
        k = room + self.width
        if self.count[k]:
            return room
        while k > 1:
            if k % 2 == 0 and self.count[k + 1]:
                k += 1
                while k < self.width:
                    k = 2 * k if self.count[2 * k] else 2 * k + 1
                return k - self.width
            k //= 2
        return None


def best_fit_plan(histogram: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, pieces a window, first sequence, offset), in the order of length and rank: piece ``r`` of the
    length goes to sequence ``first sequence + (r - first rank) // pieces a window``, and within it behind its fellows."""
    rooms, open_windows = Rooms(window), {}  # room: [(first sequence, windows)]
    plan, opened = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            open_windows.setdefault(room, []).append((first, n))
            rooms.add(room, n)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = rooms.least(length)
            if room is None:
                room, first, n = window, opened, -(-left // (window // length))
                opened += n
            else:
                first, n = open_windows[room].pop()
                rooms.add(room, -n)
            each = room // length
            placed = min(left, n * each)
            plan.append((length, rank, each, first, window - room))
            full, rest = divmod(placed, each)
            put(room - each * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
                full += 1
            put(room, first + full, n - full)
            rank, left = rank + placed, left - placed
    return plan


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``cut`` (see ``pieces``) with ``sequence_id`` and ``offset``. ``cut`` is read three times, so give it checkpointed.

    Only counts reach the driver: one for each length, then one for each part of a length, at most ``PARTS + window`` numbers."""
    many = {row["length"]: row["count"] for row in cut.groupBy("length").count().collect()}
    rows_a_part = max(LEAST_ROWS, sum(many.values()) // PARTS)
    parts = F.split(F.lit(",".join(str(-(-many.get(n, 1) // rows_a_part)) for n in range(window + 1))), ",").cast("array<int>")
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.get(parts, F.col("length").cast("int"))).cast("int"))
    counts = np.array(sorted(tuple(row) for row in dealt.groupBy("length", "part").count().collect()), np.int64).reshape(-1, 3)
    part_keys = counts[:, 0] << 32 | counts[:, 1]
    before = np.cumsum(counts[:, 2]) - counts[:, 2]
    base = before - before[np.searchsorted(counts[:, 0], counts[:, 0])]
    plan = best_fit_plan(many, window)
    plan.sort()
    lengths, first_ranks, each, sequences, offsets = np.array(plan, np.int64).reshape(-1, 5).T
    shared = cut.sparkSession.sparkContext.broadcast((part_keys, base, lengths << 40 | first_ranks, first_ranks, each, sequences, offsets))
    by_part = Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = dealt.withColumn("rank", F.row_number().over(by_part) - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_keys, base, keys, first_ranks, each, sequences, offsets = shared.value
        for batch in batches:
            length, part, rank = (batch.column(n).to_numpy() for n in ("length", "part", "rank"))
            rank = rank + base[np.searchsorted(part_keys, length << 32 | part)]
            at = np.searchsorted(keys, length << 40 | rank, "right") - 1
            sequence = sequences[at] + (rank - first_ranks[at]) // each[at]
            offset = offsets[at] + (rank - first_ranks[at]) % each[at] * length
            kept = [batch.column(n) for n in cut_names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*cut_names, "sequence_id", "offset"])

    cut_names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return ranked.select(*cut_names, "part", "rank").mapInArrow(place, ", ".join(f"{n} long" for n in [*cut_names, "sequence_id", "offset"]))


def packed(docs: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    return pack(checkpointed(pieces(docs, path, window, end)), window)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
