"""Texts in any script go through the table of pre-tokens."""

from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from millrace.llm import tokens


@pytest.fixture(scope="module")
def path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_any_script_equals_the_library(path):
    rng = random.Random(3)
    alphabet = [*"abc de  12\n\t '’“”—…€漢字かなКирαβγ　 ​\x85\x1ć", "😀", "👩‍👧", "\U00020000", "<|endoftext|>", "'s"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 80))) for _ in range(4000)] + ["漢字、かな。" * 5000, None, "", "<|endoftext|>" * 3]
    library = Tokenizer.from_file(path)
    expected = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert list(tokens.PieceCounter(path).counts(texts)) == expected


def test_pre_tokens_are_encoded_once(path):
    counter = tokens.PieceCounter(path)
    list(counter.counts(["один два “три” один", "два   один<|endoftext|> один"]))
    assert {" один", " два", "один", "два", " “", "три", "”"} <= set(counter.table)
    assert not any("<|" in p or "один д" in p for p in counter.table)


def test_a_tokenizer_that_normalises_is_refused(path, tmp_path):
    from tokenizers.normalizers import Lowercase

    changed = Tokenizer.from_file(path)
    changed.normalizer = Lowercase()
    changed.save(str(tmp_path / "t.json"))
    with pytest.raises(ValueError, match="normalises"):
        list(tokens.PieceCounter(str(tmp_path / "t.json")).counts(["A"]))
