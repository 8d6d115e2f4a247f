"""Public tokenizer files: where they lie and how text is cut before merging."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

#: Fixed value: the pre-token pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Folder of the vocabulary files; a parameter of every operator that needs one.
FOLDER = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
BYTE_BPE = "byte_bpe_50k.tiktoken"


@lru_cache(maxsize=4)
def ranks(folder: str = FOLDER, name: str = BYTE_BPE) -> dict[bytes, int]:
    """Token bytes to id, read once per process."""
    with open(os.path.join(folder, name), "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=4)
def encoding(folder: str = FOLDER, name: str = BYTE_BPE):
    """Encoder of the vocabulary, without special tokens."""
    import tiktoken

    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks(folder, name), special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(folder: str = FOLDER, name: str = BYTE_BPE) -> tuple[bytes, ...]:
    """Id to token bytes."""
    table = ranks(folder, name)
    out = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        out[rank] = token
    return tuple(out)
