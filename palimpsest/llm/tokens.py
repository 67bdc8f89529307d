"""Sizes of texts in tokens of a public byte-level tokenizer."""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame

#: Rank file; any machine that runs tasks must have it. A parameter of every operator that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_loaded: dict = {}


def encoding(path: str):
    """The tokenizer of a rank file, loaded once per process; special strings in a text are ordinary text."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding("text", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def token_counts(docs: DataFrame, keep: list[str], path: str = VOCABULARY) -> DataFrame:
    """``keep`` columns and ``n_tokens`` of every row; NULL and empty texts have 0. Texts do not leave their scan task."""

    def run(batches):
        import numpy as np

        e = encoding(path)
        for pdf in batches:
            out = pdf[keep].copy()
            out["n_tokens"] = np.array([len(e.encode_ordinary(t)) if t else 0 for t in pdf["text"]], dtype=np.int64)
            yield out

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in keep)
    return docs.select(*keep, "text").mapInPandas(run, f"{fields}, n_tokens long")
