"""Token counts by a public tokenizer whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files lie; the environment may name another folder.
FOLDER = os.environ.get("CAIRNFLOW_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The pattern that splits text before the merges of the rank files (fixed value of that vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_loaded: dict[str, object] = {}


def encoding(path: str):
    """The tokenizer of a rank file, loaded once per worker."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _loaded[path] = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def count_tokens(text: str | None, path: str) -> int:
    """Tokens of ``text``; NULL and empty texts have none, special-token strings are ordinary text."""
    return len(encoding(path).encode_ordinary(text)) if text else 0


def with_tokens(df: DataFrame, keep: list[str], text: str = "text", path: str | None = None, name: str = "n_tokens") -> DataFrame:
    """``keep`` and the token count of every whole text, a long each; the texts themselves go no further."""
    path = path or os.path.join(FOLDER, VOCABULARY)
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", `{name}` bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = pa.array([count_tokens(t.as_py(), path) for t in batch.column(len(keep))], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), counts], names=[*keep, name])

    return df.select(*keep, F.col(text)).mapInArrow(count, schema)
