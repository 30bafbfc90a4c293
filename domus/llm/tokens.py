"""Access to public tokenizer files (their folder is a parameter)."""

from __future__ import annotations

import functools


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t
