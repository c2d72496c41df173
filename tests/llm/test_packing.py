import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallymark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def cost(places, penalties, chosen, length):
    total, begin = 0.0, 0
    price = dict(zip(places, penalties))
    for end in chosen:
        n = end - begin
        assert 0 < n <= length
        total += price[end] + (0 if n & (n - 1) == 0 else length - n)
        begin = end
    return total


@pytest.mark.parametrize("seed", range(5))
def test_cuts_are_best(seed):
    rng, length = random.Random(seed), 16
    for _ in range(50):
        steps = [rng.randint(1, 9) for _ in range(rng.randint(1, 11))]
        places = np.cumsum(steps)
        penalties = np.array([float(rng.randint(0, 6)) for _ in steps])
        best = None
        for mask in range(1 << (len(steps) - 1)):
            chosen = [int(p) for i, p in enumerate(places[:-1]) if mask >> i & 1] + [int(places[-1])]
            sizes = np.diff([0, *chosen])
            if sizes.max() <= length:
                value = cost(places.tolist(), penalties.tolist(), chosen, length)
                best = value if best is None else min(best, value)
        got = packing.cuts(places, penalties, length)
        assert cost(places.tolist(), penalties.tolist(), got, length) == best


def test_word_ids_equal_the_tokenizer():
    tokenizer = Tokenizer.from_file(PATH)
    ids = packing.WordIds(PATH)
    for text in ("", "Hello, World.  It's\n\nfine!", "a\tb\r\nc", "İ. İ, x", "été, été.",
                 "<|endoftext|> x", "<|ENDOFTEXT|> <|EndOfText|>, The the THE. été. ÉTÉ.", "12.5% off...", " lead and trail ", "क़. 하.", "x" * 500):
        assert ids(text)[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_forgetting_words(monkeypatch):
    monkeypatch.setattr(packing, "_WORDS", 20)
    tokenizer, ids = Tokenizer.from_file(PATH), packing.WordIds(PATH)
    for i in range(10):
        text = " ".join(f"word{j}, stop{j}." for j in range(i, i + 12))
        assert ids(text)[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_marks_behind_words_make_no_new_words():
    ids = packing.WordIds(PATH)
    ids.of(["Café thonre été , . !! ... *** ?\""])
    known = ids.known
    text = "CAFÉ!! thonre... ÉTÉ*** thonre, été. Thonre?\" café***\nThonre!!"
    assert ids(text)[0].tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert ids.known == known


def test_division_sign_is_no_letter():
    tokenizer, ids = Tokenizer.from_file(PATH), packing.WordIds(PATH)
    for text in ("÷.", "a÷, b", "÷... ×. x×,"):
        assert ids(text)[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("seed", range(4))
def test_odd_texts_together(seed):
    rng, tokenizer, ids = random.Random(seed), Tokenizer.from_file(PATH), packing.WordIds(PATH)
    parts = [*"abcZÉßœ÷×İıªé12 .,!?'\"*|<>~\t\n\r\u0301\u00a0\u0338", "😀", "Ⱥ", "ǅ", "क़", "Σ", " ", "\n", " the", "'s", "'LL ", "...", ".' ",
             "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>. ", "=\u0338"]
    for _ in range(300):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(rng.randint(1, 4))]
        for text, (got, ends) in zip(texts, ids.of(texts), strict=True):
            assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, texts
            words = text.replace("\n", " \n ").split(" ")
            sizes = np.cumsum([len(tokenizer.encode(w, add_special_tokens=False).ids) for w in words])
            want = {int(n) for n, w in zip(sizes, words) if w[-1:] in (".", "!", "?", "\n")}
            assert {int(n) for n in ends} == want, texts
    assert ids.of([]) == []


def check(rows, texts):
    """Every id once, sequences gapless; returns padding and number of sequences."""
    tokenizer = Tokenizer.from_file(PATH)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == texts.keys()
    for doc_id, own in pieces.items():
        ids = [*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids[at : at + r.length]
            assert zlib.crc32(bytes(r.ids)) == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.LENGTH
        padding += 0 if at & (at - 1) == 0 else packing.LENGTH - at
    return padding, len(sequences)


def test_round_trip(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    padding, n = check(packing.pack(docs, PATH).collect(), texts)
    assert padding < 0.02 * n * packing.LENGTH


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "word " * 9000, 0), (None, "x", 0), (5, "One. Two.\nThree", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").coalesce(1)
    check(packing.pack(docs, PATH).collect(), {r[0]: r[1] for r in rows})
    assert packing.pack(docs.limit(0), PATH).count() == 0
