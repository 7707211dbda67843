"""Packing: exact ids, gapless sequences, capacities."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tidemark.llm import packing
from tidemark.llm.queries import tokenizer_path
from tokenizers import Tokenizer

ODD = [
    None, "", " ", "a", "don't we'll I'd 'tis x's", "a  b\n\n\n c\t\td ", "é ö 　x  ",
    "<|endoftext|>", "a  <|endoftext|> b", "x" * 5000, "12abc34 ½²Ⅷ _a_b", "\x1c\x1d\x1e\x1f \x85 ​",
    "日本語 テキスト 한국어", "éé", "🙂🙃 !!??", "word " * 3000,
]


def check(rows, found, tokens=1024):
    plain = Tokenizer.from_file(tokenizer_path())
    mine = defaultdict(list)
    for r in found:
        mine[r.doc_id].append(r)
    assert mine.keys() == {d for d, _ in rows}
    for doc, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [packing.END]
        at = 0
        for k, r in enumerate(sorted(mine[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and r.length <= tokens
            assert k == 0 or r.length == tokens
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= tokens
    return sequences


def test_given_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    found = packing.packed(documents, tokenizer_path()).collect()
    sequences = check(rows, found)
    assert len(sequences) <= 1.02 * sum(r.length for r in found) / 1024 + 1


def test_odd_texts_and_small_shards(frame):
    rows = list(enumerate(ODD * 3))
    found = packing.packed(frame(rows), tokenizer_path(), shard=10).collect()
    check(rows, found)
    assert packing.packed(frame([]), tokenizer_path()).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_binds(rule):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 400, 500)
    limits = packing.Capacity(tokens=1024, documents=5, attention=250_000, rule=rule, weights=(1.0, 0.5, 0.5))
    bins, offsets = packing.best_fit(lengths, limits)
    for b in set(bins.tolist()):
        own = lengths[bins == b]
        assert own.sum() <= 1024 and len(own) <= 5 and (own**2).sum() <= 250_000
        order = np.argsort(offsets[bins == b])
        assert (offsets[bins == b][order] == np.concatenate([[0], np.cumsum(own[order])[:-1]])).all()


def test_other_vocabularies_fall_back():
    encode = packing.encoder(tokenizer_path("word_bpe_49k.json"))
    plain = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    assert encode("Hello there, WORLD") == plain.encode("Hello there, WORLD", add_special_tokens=False).ids
