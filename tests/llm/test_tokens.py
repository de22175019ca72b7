import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelweave.llm import token_counts, token_files

WORD, BYTE = (public_tokenizers.path(m.VOCABULARY) for m in (token_counts, token_files))
TEXTS = [
    None, "", " ", "\n", "a", "Hello  World", "x <|endoftext|> y", "x<|startoftext|>y's it's", "tab\tand\nline \n\n end ", " lead", "é ̈b é  x y　z", "no break",
    "a\n b", "a \nb", "12 345,6 don't WE'LL", "long" * 5000, "word " * 3000, "\x1cx y\x1f z", "日本語 text ß Straße", "a\r\nb\x0bc\x0cd",
]


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE)


def count(t, text):
    return len(t.encode(text or "", add_special_tokens=False).ids)


def test_counts(documents, word, monkeypatch):
    docs = documents(*TEXTS).withColumn("n_tokens", F.lit("clash"))
    rows = sorted(token_counts.digest(docs).collect())
    assert [tuple(r) for r in rows] == [(k, len((t or "").encode()), count(word, t), count(word, t) > 2048) for k, t in enumerate(TEXTS)]
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 7)
    encoded = [None if t is None else t.encode() for t in TEXTS]
    assert token_counts.token_counts(encoded, len(encoded), WORD).tolist() == [count(word, t) for t in TEXTS]


def test_given_documents(given, word, byte):
    docs = given("documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.digest(docs).collect()} == {i: count(word, t) for i, t in texts.items()}
    check(token_files.digest(docs), sorted(texts.items()), byte)


def check(df, pairs, byte):
    start, want = 0, []
    for i, text in pairs:
        ids = np.array([*byte.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, df.collect()), key=lambda r: r[1]) == want


def test_files(documents, byte):
    docs = documents(*TEXTS).withColumn("start", F.lit("clash"))
    check(token_files.digest(docs), list(enumerate(TEXTS)), byte)


def test_null_and_repeated_ids_and_nothing(documents, byte):
    docs = documents((5, "b", "a"), (None, "n", "a"), (5, "a", "a"), (-3, "c", "a"))
    check(token_files.digest(docs), [(None, "n"), (-3, "c"), (5, "a"), (5, "b")], byte)
    assert token_files.digest(docs.filter("false")).count() == 0
    assert token_counts.digest(docs.filter("false")).count() == 0


def test_one_document_by_its_offset(documents, byte, tmp_path):
    docs = documents(*TEXTS)
    spec, manifest = token_files.write(docs, str(tmp_path), BYTE)
    for row in manifest.collect():
        shard = token_files.Shard(spec, row["name"])
        for k, i in enumerate(shard.doc_ids):
            assert shard.ids(k).tolist() == [*byte.encode(TEXTS[i] or "", add_special_tokens=False).ids, 0]
    other = token_files.Format(spec.folder, spec.path, spec.width, b"another")
    with pytest.raises(ValueError):
        token_files.Shard(other, row["name"])


@settings(max_examples=300, deadline=None)
@cases(st.lists(st.sampled_from(["a", "Bc", "é", " ", "  ", "\n", "\t", "'s", "'", ".", "1", " ", "̈", "<|endoftext|>", "\x1d", "日"]), max_size=14))
def test_pieces_change_no_token(parts):
    text = "".join(parts)
    t = token_counts.tokenizer(BYTE)
    assert token_files.token_ids([text.encode()], BYTE)[0] == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    w = token_counts.tokenizer(WORD)
    assert token_counts.token_counts([text.encode()], 1, WORD)[0] == len(w.encode(text, add_special_tokens=False).ids)
