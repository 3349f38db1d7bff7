"""Sizes of texts in tokens of a public byte-level BPE tokenizer."""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to the vocabulary file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, id_col: str, text_col: str, *keep: str, path: str = RANKS) -> DataFrame:
    """(id, *keep, tokens long): whole texts; null and empty texts have 0 tokens. The vocabulary
    file needs to be on the driver only; it is sent to the executors."""
    df.sparkSession.sparkContext.addFile(path)
    name = os.path.basename(path)
    kept = [df.schema[c] for c in (id_col, *keep)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", tokens long"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(SparkFiles.get(name))
        for f in frames:
            out = f[[id_col, *keep]].copy()
            out["tokens"] = [len(enc.encode_ordinary(t)) if t else 0 for t in f["_t"]]
            yield out

    return df.select(id_col, *keep, F.col(text_col).alias("_t")).mapInPandas(run, schema)
