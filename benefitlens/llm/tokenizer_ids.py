"""Ids of the public byte-level tokenizer, through the tokenizers library, for tasks.

One table a Python worker and vocabulary file: the library tokenises each word
once while it stays in the bounded table (``words.WordTable``).
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers

from benefitlens.llm.words import WordTable, groups, ragged, with_mark

#: GPT-style files: the text form of the 256 bytes. Printable bytes stand for themselves, the rest follow 256.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


@functools.cache
def byte_letters() -> dict[int, str]:
    hidden = [b for b in range(256) if b not in _PRINTABLE]
    return {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def vocabulary_path(name_or_path: str) -> str:
    """A file of the installed public vocabularies by its name, or any other file by its path."""
    return name_or_path if os.sep in name_or_path else public_tokenizers.path(name_or_path)


@functools.cache
def special_token(name: str) -> tuple[str, int]:
    (added,) = json.load(open(vocabulary_path(name), encoding="utf-8"))["added_tokens"]
    return added["content"], added["id"]


@functools.cache
def id_table(name: str) -> WordTable:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    model, letters = tokenizer.model, byte_letters()
    return WordTable(lambda words: ragged([t.id for t in model.tokenize(w.encode("utf-8").decode("latin-1").translate(letters))] for w in words))


def ids_of(name: str, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, ids, ids of each text) of one group of texts after another, as the library's
    ``encode(text, add_special_tokens=False)`` gives them: the special token's string inside a text is that token."""
    mark, number = special_token(name)
    for first, group in groups(texts):
        yield first, *with_mark(id_table(name), mark, number, group)
