"""Where the public tokenizers' vocabularies lie."""

from __future__ import annotations

import public_tokenizers


def path(name: str) -> str:
    return public_tokenizers.path(name)


def byte_bpe() -> tuple[str, str, str]:
    """Vocabulary file, the same as ranks, and the pattern that splits text before merges."""
    return path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
