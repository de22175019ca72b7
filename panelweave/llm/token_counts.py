"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only.

The vocabulary drops white space, so a text may be cut at any ASCII white
space without changing its tokens. Texts are gathered into batches of about
``BATCH_BYTES``; a longer one is cut into several at such a boundary. Within a
batch only the distinct words that were not met before are encoded, again in
batches of that many bytes, and a text's count is the sum over its words.

A null or empty text has no tokens. Repeated rows are counted each; extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.llm.shared import encoded, small_batches

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048  # tokens
BATCH_BYTES = 1 << 20
KNOWN, LONGEST = 1 << 20, 64  # words that a worker remembers, and their bytes at most
MARKS = frozenset((b".", b",", b";", b":", b"!", b"?"))

_SPACE = re.compile(rb"[ \t-\r]")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def _memory(path: str) -> dict[bytes, int]:
    """Lengths of the words met so far. A worker keeps them from task to task."""
    return {}


def balanced(items: Iterable[bytes]) -> Iterator[list[bytes]]:
    """``items`` in lists of about ``BATCH_BYTES``."""
    held, size = [], 0
    for item in items:
        held.append(item)
        size += len(item)
        if size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def chunks(text: bytes) -> Iterator[bytes]:
    """``text`` in pieces of about ``BATCH_BYTES`` that begin at white space."""
    at = 0
    while len(text) - at > BATCH_BYTES:
        found = _SPACE.search(text, at + BATCH_BYTES)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def _stem(word: bytes) -> tuple[bytes, bytes]:
    """``word`` without a mark after an ASCII letter, which is a token of its own, and the mark. The vocabulary knows no case."""
    stem, mark = (word[:-1], word[-1:]) if word[-1:] in MARKS and word[-2:-1].isalpha() else (word, b"")
    return stem.lower() if stem.isalpha() else stem, mark


def lengths(words: list[list[bytes]], path: str) -> list[int]:
    """Tokens in each list of words."""
    memory = _memory(path)
    if len(memory) > KNOWN:
        memory.clear()
    wanted = set().union(*words)
    stems = {w: _stem(w) for w in wanted if w not in memory}
    here = {}
    for batch in balanced(w for w in {stem for stem, _ in stems.values()} if w not in memory):
        found = tokenizer(path).encode_batch([w.decode() for w in batch], add_special_tokens=False)
        here.update(zip(batch, map(len, found)))
    for w, (stem, mark) in stems.items():
        here[w] = (here[stem] if stem in here else memory[stem]) + (mark != b"")
    memory.update((w, n) for w, n in here.items() if len(w) <= LONGEST)
    if all(len(w) <= LONGEST for w in here):
        return [sum(map(memory.__getitem__, own)) for own in words]
    return [sum(memory[w] if w in memory else here[w] for w in own) for own in words]


def token_counts(texts: Iterable[bytes | None], n: int, path: str) -> np.ndarray:
    """Tokens of each of the ``n`` texts."""
    out = np.zeros(n, "i8")
    owner, held, size = [], [], 0

    def settle():
        np.add.at(out, owner, lengths([c.split() for c in held], path))

    for k, text in enumerate(texts):
        for chunk in chunks(text or b""):
            owner.append(k)
            held.append(chunk)
            size += len(chunk)
            if size >= BATCH_BYTES:
                settle()
                owner, held, size = [], [], 0
    if held:
        settle()
    return out


def digest(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """The query's columns: doc_id, n_bytes, n_tokens, over_limit. No row is dealt out: input splits are balanced by bytes."""
    path = path or public_tokenizers.path(VOCABULARY)
    small_batches(docs.sparkSession)

    @F.arrow_udf(T.LongType())
    def tokens(texts: pa.Array) -> pa.Array:
        return pa.array(token_counts(encoded(texts), len(texts), path))

    counted = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), tokens(F.col("text")).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
