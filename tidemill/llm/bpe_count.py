"""Operator 10: how many tokens a byte-pair vocabulary makes of a text.

Heap-and-linked-list merging: a text's symbols form a linked list, a heap holds the adjacent pairs that
the vocabulary can merge, and the pair of the lowest rank (leftmost of equals) is popped again and again.
The count is the number of initial symbols minus the merges; no identifier is ever made.

Defined results: a null text counts as empty and has no tokens; an empty table gives no rows; repeated
rows are counted each; other columns are ignored. Texts of any length are counted whole: a text falls
into independent chunks at word starts, as no piece of the vocabulary reaches across one."""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.tables import read_table, texts

SPACE = "▁"
#: Chunks whose counts a worker remembers; beyond that it starts anew. A speed setting: results never depend on it.
REMEMBERED = 1_000_000


class Vocabulary:
    """Ranks of the pieces (0 is merged first), and how many symbols an unknown character makes."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        partners = [p for p in ranks if len(p) > 1]
        if any(c not in ranks for p in partners for c in p):
            raise ValueError("a piece has a character that is no piece; counts would depend on its merges")
        inner = {c for p in partners for c in p[1:]}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in partners):
            raise ValueError("a piece reaches across a word start")
        self.together = {p[i : i + 2] for p in partners for i in range(len(p) - 1)}
        self.newline_alone = "\n" not in inner and not any(p[0] == "\n" for p in partners)

    @classmethod
    def from_sentencepiece(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        normal.sort(key=lambda i: (-model.get_score(i), i))
        score, rank, ranks = None, -1, {}
        for i in normal:
            if model.get_score(i) != score:
                score, rank = model.get_score(i), rank + 1
            ranks[model.id_to_piece(i)] = rank
        return cls(ranks)

    def count(self, chunk: str) -> int:
        """Tokens of a chunk, by merging."""
        ranks = self.ranks
        symbols = list(chunk)
        n = len(symbols)
        total = sum([1 if c in ranks else len(c.encode()) for c in symbols])
        shift = n.bit_length()
        # An entry of the heap is a pair's rank and the place of its left symbol, in one number.
        heap = [ranks[pair] << shift | i for i, pair in enumerate(map(str.__add__, symbols, symbols[1:])) if pair in ranks]
        heapq.heapify(heap)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while heap:
            entry = heapq.heappop(heap)
            i = entry & ((1 << shift) - 1)
            j = after[i]
            if j >= n or symbols[i] is None or ranks.get(pair := symbols[i] + symbols[j]) != entry >> shift:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = pair, None
            total -= 1
            after[i] = j = after[j]
            if j < n:
                before[j] = i
                if (new := pair + symbols[j]) in ranks:
                    heapq.heappush(heap, ranks[new] << shift | i)
            if (h := before[i]) >= 0 and (new := symbols[h] + pair) in ranks:
                heapq.heappush(heap, ranks[new] << shift | h)
        return total

    def parts(self, chunk: str) -> list[str]:
        """The chunk cut between characters that stand together in no piece, so that no merge crosses a cut."""
        whole = list(map(self.together.__contains__, map(str.__add__, chunk, chunk[1:])))
        if False not in whole:
            return [chunk]
        cuts = [i for i, together in enumerate(whole, 1) if not together]
        return [chunk[i:j] for i, j in zip([0, *cuts], [*cuts, len(chunk)])]


class _Counts(dict):
    """Counts of chunks, made when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, chunk: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        parts = self.vocabulary.parts(chunk)
        n = self.vocabulary.count(chunk) if len(parts) == 1 else sum(map(self.__getitem__, parts))
        if len(chunk) <= 64:
            self[chunk] = n
        return n


def counter(vocabulary: Vocabulary) -> Callable[[str], int]:
    """Counts the tokens of a text, as it is, with a space put before it and spaces shown by a symbol."""
    counts = _Counts(vocabulary)
    chunks = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if vocabulary.newline_alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def count(text: str) -> int:
        if not text:
            return 0
        return sum(map(counts.__getitem__, chunks.findall(SPACE + text.replace(" ", SPACE))))

    return count


@lru_cache(maxsize=2)
def _counter(path: str) -> Callable[[str], int]:
    return counter(Vocabulary.from_sentencepiece(path))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 4096) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row. ``vocabulary``: path of a sentencepiece
    model that every executor has. One pass without a shuffle; texts stay in their partitions."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _counter(vocabulary)
        for batch in batches:
            lengths = [of(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(lengths, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    sized = texts(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return sized.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op10_bpe_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read_table(spark, sf_dir, "documents"), str(public_tokenizers.path("piece_bpe_32k.model")))
