"""Ids of whole texts from their pieces."""
import random

from estatelens.llm import packing
from estatelens.llm.tokens import Encoder


def test_pieces_give_the_ids_of_the_whole_text():
    encoder, r = Encoder(packing.vocabulary()), random.Random(3)
    marks = [" ", " ", "  ", "\n", "\t", "a", "bc", "'s", "<|endoftext|>", "<|", "12", "é", "\u3000", "\u00a0", ".", "中文", "😀", "The", "Ġ", "\r\n", "\x00", "\x1c", " \n"]
    texts = ["", " ", *("".join(r.choice(marks) for _ in range(r.randrange(14))) for _ in range(4000))]
    for size in (1, 7, 997):
        assert [x for a in range(0, len(texts), size) for x in encoder.batch(texts[a:a + size])] == encoder._encode(texts)
    assert encoder.batch([]) == []


def test_new_words_are_encoded_many_at_once(monkeypatch):
    encoder, seen, encode = Encoder(packing.vocabulary()), [], Encoder._encode
    monkeypatch.setattr(Encoder, "_encode", lambda self, texts: (seen.extend(texts), encode(self, texts))[1])
    text = " ".join(f"qz{i}x" for i in range(700))
    assert encoder.batch([text]) == encode(encoder, [text])
    assert len(seen) <= 3
