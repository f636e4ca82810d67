"""Words of the packing operator against the tokenizer, how often it is asked, and what is remembered."""

import random

import numpy as np

from tessera.llm import packing as P
from tessera.llm import queries as Q

#: Every character of plain words, and others that go to the tokenizer.
PLAIN = [chr(c) for c in range(0x21, 0x180) if P._PLAIN.fullmatch(chr(c))]
OTHER = list("–…“”€×÷İẞΣς日本́ﬁ½²Ж­​")


def _ids(tokenizer, text):
    return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def _texts(seed, chars, n=300):
    rng = random.Random(seed)
    parts = [*chars, *("'s", "'LL", "'Re", "the", "Ing", "tion", "ñá", "42", "--", "<|", "|>")]
    words = ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(3 * n)]
    return [rng.choice([" ", "\n", " \t"]).join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(n)]


class Counted:
    def __init__(self, tokenizer):
        self.tokenizer, self.asked = tokenizer, 0

    def encode(self, *args, **more):
        self.asked += 1
        return self.tokenizer.encode(*args, **more)


def test_words_have_the_tokenizers_ids():
    encoder = P.WordEncoder(str(Q.tokenizer_path()))
    texts = [*PLAIN, " ".join(PLAIN), "".join(PLAIN), *_texts(1, PLAIN), *_texts(2, [*PLAIN[::7], *OTHER]), *_texts(3, list("'sSlLtT|<>"))]
    texts += ["", " \n", "a\x1cb", "x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|", "long" * 3000]
    want = [_ids(encoder.tokenizer, t) for t in texts]
    assert list(encoder.texts(texts)) == want
    assert list(encoder.texts(texts)) == want  # from memory


def test_plain_words_go_straight_to_the_model():
    encoder = P.WordEncoder(str(Q.tokenizer_path()))
    texts = [t for t in _texts(4, PLAIN) if "<|" not in t]
    want = [_ids(encoder.tokenizer, t) for t in texts]
    encoder.tokenizer = Counted(encoder.tokenizer)
    assert list(encoder.texts(texts)) == want
    assert len(texts) > 20 and encoder.tokenizer.asked == 0
    list(encoder.texts(["日本 日本 日本"]))
    assert encoder.tokenizer.asked == 1  # each other word once


def test_words_remember_a_bounded_number_and_begin_a_task_with_the_first_met():
    worked = []

    def encode(words, word):
        worked.append(word)
        return word.encode()

    words = P.Words(encode, 50)
    for k in range(40):
        words = words.turn()
        for w in ["the", "of", *(f"w{k}_{i}" for i in range(20))]:
            assert words[w] == w.encode()
        assert len(words) <= 72 and len(words.older) <= 72
    assert worked.count("the") == worked.count("of") == 1 and len(worked) == len(set(worked)) == 802
    rested = words.rest(10)
    assert len(rested) <= 10 and not rested.older and {"the", "of"} <= rested.keys()
