"""Words of ASCII letters are encoded without the tokenizer's normaliser and patterns, to the same ids."""

import numpy as np

from riskframe.llm.tokens import WordIds


def test_plain_words_skip_the_normaliser():
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["The Quick brown fox, thelyouble!", "İstanbul naïve don't 3x ab-c s t re", "ONE one One. ſ K", "pad unk endoftext <|endoftext|> a"]
    coder = WordIds(path)
    for t in texts:
        assert coder.ids(t) == coder._direct(t), t
    coder = WordIds(path)
    whole, coder.tokenizer = coder.tokenizer, None  # no plain word goes there
    got = coder.ids("The Quick brown fox thelyouble fox FOX")
    assert got == np.array(whole.encode("The Quick brown fox thelyouble fox FOX", add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert not coder.words and {"the", "fox", "FOX", "thelyouble"} <= set(coder.runs)  # a plain word is remembered once
