"""Token counts of texts with a public tokenizer, and ordered sums over groups of any size."""

from __future__ import annotations

import base64
import os
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Ranks of a public byte-level vocabulary; another file of the same form may be given.
VOCABULARY = os.environ.get("EVENFALL_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: how that vocabulary's texts are cut before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Rows that one ordered running sum spans, on average.
GROUP_ROWS = 20_000

_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    if path not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


_LONG_SPACE = re.compile(r"\s{20000}")


def count_tokens(e, text: str) -> int:
    """Tokens of the whole text. Very long white space overflows the encoder's own splitting, so such texts are cut here by the same pattern."""
    if not text:
        return 0
    if not _LONG_SPACE.search(text):
        return len(e.encode_ordinary(text))
    import regex

    return sum(len(e._encode_single_piece(m[0].encode())) for m in regex.finditer(PATTERN, text))


def with_tokens(df: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds tokens LONG, the number of tokens of the whole text; 0 for null and empty texts."""

    def count(texts: pd.Series) -> pd.Series:
        e = encoder(vocabulary)
        return pd.Series([count_tokens(e, t) for t in texts], dtype="int64")

    return df.withColumn("tokens", F.pandas_udf(count, "long")(F.coalesce(F.col(text), F.lit(""))))


def running_sum(df: DataFrame, group: list[str], key: Column, order: list[str], value: Column, rows: int, name: str = "before") -> DataFrame:
    """Adds name, the sum of value over all rows of the group in front, by a uniformly distributed hash key (then the order columns).

    The key's range is cut into as many equal parts as keep a part near GROUP_ROWS rows, however large a group is: parts are summed
    first, each part starts at the sum of the parts before it, and only within a part are rows sorted. Hash keys are uniform, so
    the parts are even without sampling. rows: about how many rows the largest group has.
    """
    parts = max(1, min(100_000, rows // GROUP_ROWS))
    df = df.withColumn("_key", key).withColumn("_part", F.pmod(F.shiftrightunsigned("_key", 33), F.lit(1 << 31)) * F.lit(parts) / F.lit(1 << 31))
    df = df.withColumn("_part", F.floor("_part").cast("int")).withColumn("_value", value)
    sums = df.groupBy(*group, "_part").agg(F.sum("_value").alias("_sum"))
    before = sums.withColumn("_base", F.sum("_sum").over(Window.partitionBy(*group).orderBy("_part")) - F.col("_sum")).drop("_sum")
    w = Window.partitionBy(*group, "_part").orderBy(F.shiftrightunsigned("_key", 1), "_key", *order)
    df = df.withColumn("_within", F.sum("_value").over(w) - F.col("_value"))
    return df.join(before, [*group, "_part"]).withColumn(name, F.col("_base") + F.col("_within")).drop("_key", "_part", "_value", "_base", "_within")
