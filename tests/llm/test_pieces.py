"""SentencePiece encoding with spans, decoding and normalisation against the library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from pricedex.llm import pieces
from pricedex.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", " ", "  ", "▁", "\n", "\t", "é", "😀", "é", "<s>", "<0x0A>", "\0", "​", "ﬁ", "日本", "the", "ing",
         " the", "\r\n", "　", "½", ".", "퟿", "̈́", "ｶﾞ", "가"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(3)
    return ["", " ", "  ", "\n", "▁", "▁▁ a", " a", "a ", "x" * 5000, "ab" * 3000 + "  " * 50, "é" * 100 + "zq" * 60,
            *("".join(rng.choice(PARTS) for _ in range(rng.randint(1, 60))) for _ in range(1500))]


def by_library(library, text):
    """Ids and byte spans of the library's own result."""
    rows = [dict(pieces._fields(v)) for n, v in pieces._fields(library.encode(text, out_type="serialized_proto")) if n == 2]
    return [[r.get(k, 0) for r in rows] for k in (2, 4, 5)]


def test_ids_spans_and_decoding_equal_the_library(library):
    model = pieces.model(PATH)
    for text in texts():
        found = [x.tolist() for x in model.encode(text)]
        assert found == by_library(library, text), text
        assert model.decode(found[0]).decode() == library.decode(found[0])


def test_decoding_of_any_ids(library):
    rng, model = random.Random(4), pieces.model(PATH)
    for _ in range(2000):
        ids = [rng.randrange(32000) if rng.random() < 0.4 else rng.randrange(262) for _ in range(rng.randint(0, 30))]
        assert model.decode(ids).decode() == library.decode(ids), ids


def test_a_full_memory_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 3)
    with open(PATH, "rb") as f:
        model = pieces.Model(f.read())
    for text in texts()[:200]:
        assert model.encode(text)[0].tolist() == library.encode(text)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("strip", [True, False])
def test_character_map_equals_the_library(rule, strip):
    n = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=strip, escape_whitespaces=True,
                                              remove_extra_whitespaces=strip)
    spec = next(pieces.NormaliserSpec.parse(v) for k, v in pieces._fields(n.serialized_model_proto()) if k == 3)
    own = pieces.Normaliser(spec)
    for text in [*texts()[:500], *(chr(c) for c in range(1, 0x3400))]:
        data, origin = own.run(text.encode())
        assert data.decode() == n.normalize(text)
        assert len(origin) == len(data) + 1 and (origin[1:] >= origin[:-1]).all() and origin[-1] <= len(text.encode())
    if rule == "nfkc_cf":  # longest prefix: a letter with its accent, and three letters out of one
        data, origin = own.run("Aéﬃ".encode())
        start = len(data) - len("aéffi".encode())
        assert data[start:].decode() == "aéffi" and origin[start:].tolist() == [0, 1, 1, 4, 4, 4, 7]


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        pieces.Model(b"")


def test_encode_and_decode_tables(spark):
    rows = [(1, "two  spaces", "x", 1), (None, None, "y", 2), (2, "", None, None), (2, "", None, None), (3, "é" * 200_000, "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, starts int")
    encoded = pieces.encode(docs, PATH)
    found = pieces.decode(encoded, PATH).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in found) == sorted((r[0] or 0, r[1] or "") for r in rows)
    for r in found:
        assert len(r.ids) == len(r.starts) == len(r.ends)
    assert pieces.decode(pieces.encode(docs.limit(0), PATH), PATH).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert sorted(tuple(r)[::2] for r in pieces.decode(nulls, PATH).collect()) == [(1, None), (2, "")]


def test_query_on_the_given_table(spark, library):
    sf = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in QUERIES["op13_sentencepiece_roundtrip"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for r in rows:
        text = r.text or ""
        ids = library.encode(text)
        got = found[r.doc_id]
        assert got.n_tokens == len(ids) and got.covered_bytes == len(text.encode())
        assert got.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
