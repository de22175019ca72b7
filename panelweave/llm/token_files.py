"""Token ids in binary shards: each document a zstandard frame under one shared dictionary, found by an offset index.

A shard is two files. ``.bin``: the header, then the documents' frames.
``.idx``: the header, the number of documents, then their ids, a byte each
that is 0 for a null id, offsets into the ``.bin`` (one more than documents)
and token counts, all little-endian. The header is ``MAGIC`` and the SHA-256
of the dictionary, which lies beside the shards. Ids are 16 bits wide if the
vocabulary allows, else 32. A reader fetches one short document with one read.

A null or empty text is the end id alone. Null ids come first; rows of one id
are ordered by text. Extra columns are ignored. An empty table makes no shard
and gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelweave.llm.shared import encoded, partitions, small_batches
from panelweave.llm.token_counts import BATCH_BYTES, balanced, tokenizer
from panelweave.session import run_folder, stage

VOCABULARY, END = "byte_bpe_50k.json", 0
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY = 256, 16_384, 1 << 16  # documents, ids of each and bytes of the dictionary trained on them
LEVEL = 3
KNOWN, LONGEST = 3 << 19, 64  # words whose ids a worker remembers, and their bytes at most
MARKS = [b".", b",", b";", b":", b"!", b"?"]
MAGIC = b"PWIDS\x01"
WIDTHS = {2: "<u2", 4: "<u4"}
_CUT = re.compile(rb"(?<=[A-Za-z0-9.,])(?=[ \n][A-Za-z0-9])")
_BLANK = frozenset(b" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f")

MANIFEST = "shard int, name string, documents bigint, tokens bigint, bytes bigint"
RESULT = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def place(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it, for a folder that all executors share."""
    if folder.startswith("/"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


@lru_cache(maxsize=4)
def _memory(path: str) -> tuple[dict[bytes, bytes], dict[bytes, bytes]]:
    """Ids of the words met so far, at the head of a line and after a single space. A worker keeps them from task to task."""
    return {}, {}


def _solid(edge: bytes) -> bool:
    """Neither end of the piece is white space."""
    if not edge or edge[0] in _BLANK or edge[-1] in _BLANK:
        return False
    if edge[0] < 0x80 and edge[-1] < 0x80:
        return True
    text = edge.decode()
    return not text[0].isspace() and not text[-1].isspace()


def pieces(text: bytes) -> list[bytes]:
    """``text`` cut where no token can reach across: before a single space, and around a single line feed, between solid neighbours."""
    out: list[bytes] = []
    lines = text.split(b"\n")
    solid = [_solid(line) for line in lines]
    at = 0
    while at < len(lines):
        end = at + 1
        # lines that begin or end in white space stay with their neighbours
        while end < len(lines) and not (solid[end - 1] and solid[end]):
            end += 1
        if at:
            out.append(b"\n")
        words = lines[at].split(b" ") if end == at + 1 else [b""]
        if all(map(_solid, words)):
            out.append(words[0])
            out += [b" " + w for w in words[1:]]
        else:
            out.append(b"\n".join(lines[at:end]))
        at = end
    return out


def _encode(words: list[bytes], path: str) -> list[bytes]:
    out: list[bytes] = []
    for batch in balanced(words):
        found = tokenizer(path).encode_batch([w.decode() for w in batch], add_special_tokens=False)
        out += [array("I", e.ids).tobytes() for e in found]
    return out


@lru_cache(maxsize=4)
def _space(path: str) -> str | None:
    """How the vocabulary spells the space before a word, if it takes a run of ASCII letters as one piece and as it is; else None."""
    t = tokenizer(path)
    found = [piece for piece, _ in t.pre_tokenizer.pre_tokenize_str("Ab Cd")] if t.pre_tokenizer and t.normalizer is None else []
    return found[1][:-2] if len(found) == 2 and found[0] == "Ab" and found[1].endswith("Cd") else None


def _words(words: list[bytes], before: bytes, path: str) -> list[tuple[bytes, bytes]]:
    """(word, ids) of each. A word of ASCII letters is one piece, which the vocabulary's model takes without the steps before it."""
    space = _space(path)
    letters = [w for w in words if w.isalpha()] if space is not None else []
    rest = [w for w in words if not w.isalpha()] if space is not None else words
    take, lead = tokenizer(path).model.tokenize, space if before else ""
    found = [(w, array("I", [t.id for t in take(lead + w.decode())]).tobytes()) for w in letters]
    return found + list(zip(rest, _encode([before + w for w in rest], path)))


def _learn(words: set[bytes], before: bytes, known: dict[bytes, bytes], path: str) -> None:
    """The ids of the words that are new, encoded behind ``before``. A mark after an ASCII letter is a token of its own, so only the rest is encoded."""
    fit = [w for w in words if w not in known and len(w) <= LONGEST and _solid(w)]
    stems = {w: w[:-1] for w in fit if w[-1:] in MARKS and w[-2:-1].isalpha()}
    new = [w for w in {stems.get(w, w) for w in fit} if w not in known]
    known.update(_words(new, before, path))
    marks = dict(zip(MARKS, _encode(MARKS, path)))
    known.update((w, known[stem] + marks[w[-1:]]) for w, stem in stems.items())


def sections(text: bytes) -> Iterator[bytes]:
    """``text`` in pieces of about ``BATCH_BYTES`` that no token reaches across."""
    at = 0
    while len(text) - at > BATCH_BYTES:
        found = _CUT.search(text, at + BATCH_BYTES)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def token_ids(texts: list[bytes], path: str) -> list[bytes]:
    """The ids of each text, as 32-bit integers.

    Even texts (lines of words with single spaces between, no other white
    space) are looked up word by word; others are encoded in longer pieces.
    """
    head, tail = _memory(path)
    if len(head) + len(tail) > KNOWN:
        head.clear()
        tail.clear()
    split = [[line.split(b" ") for line in text.split(b"\n")] for text in texts]
    first, later = set(), set()
    for lines in split:
        for words in lines:
            first.add(words[0])
            later.update(words[1:])
    _learn(first, b"", head, path)
    _learn(later, b" ", tail, path)
    feed, out = _encode([b"\n"], path)[0], []
    for text, lines in zip(texts, split):
        try:
            out.append(feed.join([head[words[0]] + b"".join(map(tail.__getitem__, words[1:])) for words in lines]))
        except KeyError:
            out.append(b"".join(_encode(pieces(text), path)) if text else b"")
    return out


def _documents(batches, path: str) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids with the end id) of each row, in order, about ``BATCH_BYTES`` of text encoded at a time."""
    end = np.array([END], "<u4").tobytes()
    for batch in batches:
        ids, held, size, before = batch.column(0).to_pylist(), [], 0, b""

        def settled():
            nonlocal before
            for (k, last, _), found in zip(held, token_ids([part for _, _, part in held], path)):
                before += found
                if last:
                    yield ids[k], before + end
                    before = b""

        for k, text in enumerate(encoded(batch.column(1))):
            own = list(sections(text or b""))
            for n, part in enumerate(own, 1):
                held.append((k, n == len(own), part))
                size += len(part)
                if size >= BATCH_BYTES:
                    yield from settled()
                    held, size = [], 0
        yield from settled()


@dataclass(frozen=True)
class Format:
    folder: str
    path: str  # of the vocabulary
    width: int
    dictionary: bytes

    @property
    def header(self) -> bytes:
        return MAGIC + bytes([self.width]) + hashlib.sha256(self.dictionary).digest()

    def packer(self) -> zstandard.ZstdCompressor:
        held = {"dict_data": zstandard.ZstdCompressionDict(self.dictionary)} if self.dictionary else {}
        return zstandard.ZstdCompressor(level=LEVEL, **held)

    def unpacker(self) -> zstandard.ZstdDecompressor:
        held = {"dict_data": zstandard.ZstdCompressionDict(self.dictionary)} if self.dictionary else {}
        return zstandard.ZstdDecompressor(**held)


def train(docs: DataFrame, path: str, width: int) -> bytes:
    """A dictionary from a bounded sample: ``SAMPLE_DOCS`` documents by hash, ``SAMPLE_IDS`` ids of each."""
    chosen = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(SAMPLE_DOCS).select("doc_id", "text")

    def sample(batches):
        for batch in batches:
            found = [np.frombuffer(ids, "<u4")[:SAMPLE_IDS].astype(WIDTHS[width]).tobytes() for _, ids in _documents([batch], path)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["ids"])

    samples = [bytes(r["ids"]) for r in chosen.mapInArrow(sample, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little text to train on: its ids are the dictionary
        return b"".join(samples)[:DICTIONARY]


def write(docs: DataFrame, folder: str, path: str) -> tuple[Format, DataFrame]:
    """Shards in ascending ``doc_id``; the manifest names those of the attempts that finished.

    Rows are dealt by ranges of ``doc_id`` and sorted inside. A task writes
    under the name of its attempt, so a lost or repeated attempt leaves a file
    that the manifest does not know.
    """
    small_batches(docs.sparkSession)
    width = 2 if tokenizer(path).get_vocab_size() <= 1 << 16 else 4
    spec = Format(folder, path, width, train(docs, path, width))
    system, root = place(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/dictionary") as out:
        out.write(spec.dictionary)

    def shard(batches):
        context, system, root = TaskContext.get(), *place(spec.folder)
        name = f"shard-{context.partitionId():06d}-{context.taskAttemptId()}"
        packer, ids, offsets, counts, out = spec.packer(), [], [len(spec.header)], [], None
        for doc_id, found in _documents(batches, spec.path):
            if out is None:
                system.create_dir(root, recursive=True)
                out = system.open_output_stream(f"{root}/{name}.bin", buffer_size=1 << 20)
                out.write(spec.header)
            frame = packer.compress(np.frombuffer(found, "<u4").astype(WIDTHS[spec.width]).tobytes())
            out.write(frame)
            ids.append(doc_id)
            offsets.append(offsets[-1] + len(frame))
            counts.append(len(found) // 4)
        if out is None:
            return
        out.close()
        with system.open_output_stream(f"{root}/{name}.idx") as index:
            index.write(spec.header + struct.pack("<Q", len(ids)))
            index.write(np.array([i or 0 for i in ids], "<i8").tobytes())
            index.write(bytes(i is not None for i in ids))
            index.write(np.array(offsets, "<u8").tobytes() + np.array(counts, "<u8").tobytes())
        row = [[context.partitionId()], [name], [len(ids)], [sum(counts)], [offsets[-1]]]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()])], ["shard", "name", "documents", "tokens", "bytes"])

    dealt = docs.select("doc_id", "text").repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return spec, stage(dealt.mapInArrow(shard, MANIFEST))


class Shard:
    """One shard, opened for reading: ``ids(k)`` fetches the k-th document with one read."""

    def __init__(self, spec: Format, name: str):
        self.system, root = place(spec.folder)
        with self.system.open_input_stream(f"{root}/{name}.idx") as index:
            raw = index.read()
        head = len(spec.header)
        if raw[:head] != spec.header:
            raise ValueError(f"shard {name} was written with another dictionary or width")
        n, at = struct.unpack_from("<Q", raw, head)[0], head + 8
        ids = np.frombuffer(raw, "<i8", n, at)
        given = np.frombuffer(raw, "u1", n, at + 8 * n)
        self.doc_ids = [int(i) if g else None for i, g in zip(ids, given)]
        self.offsets = np.frombuffer(raw, "<u8", n + 1, at + 9 * n).astype("i8")
        self.counts = np.frombuffer(raw, "<u8", n, at + 9 * n + 8 * (n + 1)).astype("i8")
        self.spec, self.unpacker = spec, spec.unpacker()
        self.data = self.system.open_input_file(f"{root}/{name}.bin")

    def ids(self, k: int) -> np.ndarray:
        frame = self.data.read_at(int(self.offsets[k + 1] - self.offsets[k]), int(self.offsets[k]))
        return np.frombuffer(self.unpacker.decompress(frame), WIDTHS[self.spec.width])


def read(spec: Format, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files. A task reads whole shards, one document at a time."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("name", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))  # one small row a shard

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(spec, row["name"])
                crc, n = [], []
                for k in range(len(shard.doc_ids)):
                    ids = shard.ids(k)
                    n.append(len(ids))
                    crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                start = row["start"] + np.concatenate(([0], np.cumsum(n)[:-1])).astype("i8")
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64()), pa.array(start), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return starts.repartition(partitions(manifest.sparkSession)).mapInArrow(documents, RESULT)


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The query's columns, read back from files written in a folder of this run under the shared one."""
    folder = f"{run_folder(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    return read(*write(docs, folder, path or public_tokenizers.path(VOCABULARY)))
