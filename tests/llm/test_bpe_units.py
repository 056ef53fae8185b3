"""Cached units against the tokenizers library on whole texts."""

import random

import public_tokenizers
import pytest

from tillroll.llm import bpe

LETTERS = [*"abcXYZ019 \n\t'\"!?.,;:-_/\\()[]{}~`|^@#$%&*+=<>"]
OTHERS = ["é", "ß", "²", "½", "Ⅳ", "”", "“", "—", "\xa0", "　", "日", "本", "😀", "́", "ـ", "٣", "'s", "'ll", "'re", " '", "  ", "\r\n", "\x1c", "\x85", "\x00", "\x7f"]


@pytest.mark.parametrize("cache", [7, 250_000])
def test_units_end_where_pre_tokens_end(monkeypatch, cache):
    monkeypatch.setattr(bpe, "CACHE", cache)
    enc, rng = bpe.Encoder(str(public_tokenizers.path("byte_bpe_50k.json"))), random.Random(cache)
    texts = ["".join(rng.choices(LETTERS + OTHERS, k=rng.randrange(1, 40))) for _ in range(8000)]
    assert [x for i in range(0, len(texts), 500) for x in enc.encode(texts[i : i + 500])] == enc._ids(texts)


def test_words_of_more_letters_are_units_without_their_signs():
    enc, rng = bpe.Encoder(str(public_tokenizers.path("byte_bpe_50k.json"))), random.Random(3)
    assert bpe.UNIT.findall("él, ¡ñandú! señor's 12ª ǅaž7") == ["él", ",", " ¡ñandú!", " señor", "'s", " 12ª", " ǅaž", "7"]
    some = [*"aZé ßñüžÀɏɐ×÷ªµº5.,!'\n-", "ĳ", "ǅ", "́", " ", "'s", "٣"]
    texts = ["".join(rng.choices(some, k=rng.randrange(1, 40))) for _ in range(8000)]
    assert enc.encode(texts) == enc._ids(texts)
    texts = ["".join(rng.choices(some, k=rng.randrange(1, 40))) for _ in range(50)]  # mostly known units
    assert enc.encode(texts) == enc._ids(texts)


def test_each_different_unit_of_a_portion_is_looked_up_once():
    class Counted(dict):
        asked = 0

        def __getitem__(self, unit):
            self.asked += 1
            return super().__getitem__(unit)

    enc = bpe.Encoder(str(public_tokenizers.path("byte_bpe_50k.json")))
    enc.seen = Counted()
    texts = ["the cat, the dog; " * 500, "", "the dog's " * 500]
    assert enc.encode(texts) == enc._ids(texts)
    assert enc.seen.asked <= 10


@pytest.mark.parametrize("block", [3, 1 << 16])
def test_units_are_cut_at_the_patterns_borders_and_at_texts_ends(monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK", block)
    enc, rng = bpe.Encoder(str(public_tokenizers.path("byte_bpe_50k.json"))), random.Random(5)
    plain = ["".join(rng.choices(LETTERS, k=rng.randrange(0, 12))) for _ in range(3000)]
    shown = [x for x in OTHERS if x not in "\x1c\x00\x7f"]
    mixed = ["".join(rng.choices([*LETTERS, *shown, " ", "\n"], k=rng.randrange(0, 12))) for _ in range(3000)]
    for texts in (plain, mixed, ["", " ", "", "\n", "a", " ", "  ", "b"], ["é ", " é", ""], [""]):
        units, upto = enc.units(texts)
        units, starts = units.to_pylist(), [0, *upto[:-1]]
        for text, s, e in zip(texts, starts, upto):
            assert "".join(units[s:e]) == text
            cuts = lambda some: {sum(map(len, some[:i])) for i in range(len(some))}
            assert cuts(bpe.UNIT.findall(text)) <= cuts(units[s:e])
        assert enc.encode(texts) == enc._ids(texts)
    assert enc.encode([]) == []
    some = ["a b", "x <|endoftext|> y ", " y"]
    assert enc.encode(some) == enc._ids(some)
    assert enc.units(["'tis 12's, señor'5 日本,a"])[0].to_pylist() == ["'tis", " 12", "'s", ",", " señor", "'", "5", " 日本,", "a"]
