"""Sensitive columns as tokens."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.sources.snapshots import Snapshots


def token(x: Column, key: str, length: int = 18) -> Column:
    """A keyed hash (HMAC with SHA-256) of a text, in hexadecimal digits; null stays null. Equal values have equal tokens under one
    key, so that joins and upserts on tokens work. Eighteen digits are 72 bits."""
    if not key:
        raise ValueError("tokens need a key that isn't empty")
    block = key.encode() if len(key.encode()) <= 64 else hashlib.sha256(key.encode()).digest()
    inner, outer = (F.lit(bytearray(b ^ pad for b in block.ljust(64, b"\0"))) for pad in (0x36, 0x5C))
    return F.substring(F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, x.cast("binary")), 256))), 256), 1, length)


def tokenize(df: DataFrame, columns: list[str], key: str, length: int = 18) -> DataFrame:
    """``df`` with these columns as tokens; columns that it hasn't are passed over. No shuffle. Floating-point columns are
    refused, as their text form is no stable name, and so is an empty key."""
    _refuse_floats(df, columns)
    return df.select(*(token(F.col(c).cast("string"), key, length).alias(c) if c in columns else F.col(c) for c in df.columns))


Vault = Callable[[list[str]], list[str]]
TOKENS = "name string, token string"


def asked(values: DataFrame, vault: Vault, batch: int = 1000) -> DataFrame:
    """``value`` and ``token`` of different values: the vault is asked on executors, in batches, and must answer with one token for each value,
    in their order."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame["value"].tolist()
            for k in range(0, len(values), batch):
                some = values[k : k + batch]
                tokens = vault(some)
                if not isinstance(tokens, list) or len(tokens) != len(some) or not all(isinstance(t, str) and t for t in tokens):
                    raise ValueError(f"the vault gave {len(tokens) if isinstance(tokens, list) else type(tokens).__name__} for {len(some)} values")
                yield pd.DataFrame({"value": some, "token": tokens})

    return values.mapInPandas(ask, "value string, token string")


def _refuse_floats(df: DataFrame, columns: list[str]) -> None:
    for f in df.schema:
        if f.name in columns and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            raise TypeError(f"column {f.name}: floating-point numbers can't be tokenized")


def name_of(x: Column, key: str) -> Column:
    """What a value is called in the token map: its keyed hash, so that the map tells nothing of values."""
    return token(x.cast("string"), key, 64)


def learn(df: DataFrame, columns: list[str], key: str, vault: Vault, known: Snapshots) -> int:
    """Asks the vault for the values of ``columns`` that the token map doesn't have, once each, and adds them to the map. Returns how many
    there were. A value that two runs ask for at once has the token of the one that came first."""
    known.create_if_missing(T._parse_datatype_string(TOKENS))
    named = [F.struct(name_of(F.col(c), key).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]
    values = df.select(F.explode(F.array(*named)).alias("v")).select("v.*").where("name IS NOT NULL").groupBy("name").agg(F.first("value").alias("value"))
    unknown = values.join(known.read().select("name"), "name", "left_anti")
    count = Observation()
    answers = asked(unknown.observe(count, F.count(F.lit(1)).alias("n")).select("value"), vault)
    new = known.put(answers.select(name_of(F.col("value"), key).alias("name"), "token"))
    schema = T._parse_datatype_string(TOKENS)
    got = known.frame(new, schema).agg(F.count_distinct("name")).first()[0]
    if got != count.get["n"]:
        raise ValueError(f"the vault gave {got} tokens for {count.get['n']} values")

    def change(now: dict) -> tuple[list, T.StructType]:
        held = known.frame(now["files"], schema)
        late = known.frame(new, schema).join(held.select("name"), "name", "left_semi")
        files = new if late.isEmpty() else known.put(known.frame(new, schema).join(held.select("name"), "name", "left_anti"))
        return [*now["files"], *files], schema

    if got:
        known.changed(change)
    else:
        known.remove(new)
    return got


def tokenize_from(df: DataFrame, columns: list[str], key: str, known: Snapshots) -> DataFrame:
    """``df`` with these columns as the token map has them; null stays null. The map is joined once for each column; Spark broadcasts it or not
    by its size, and splits what a value that very many rows have brings to one task."""
    held, out = known.read(), df
    for c in columns:
        tokens = held.toDF("_name", "_token")
        out = out.withColumn("_name", name_of(F.col(c), key)).join(tokens, "_name", "left").withColumn(c, F.col("_token")).drop("_name", "_token")
    return out.select(*df.columns)


def tokenize_with(df: DataFrame, columns: list[str], vault: Vault, key: str, known: Snapshots) -> DataFrame:
    """As ``tokenize``, by a vault that is asked once for each value, ever: what it said before is in the token map ``known``."""
    own = [c for c in columns if c in df.columns]
    _refuse_floats(df, own)
    if own:
        learn(df, own, key, vault, known)
    return tokenize_from(df, own, key, known) if own else df
