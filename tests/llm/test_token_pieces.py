import random

import public_tokenizers

from quantelle.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_words_at_line_feeds_and_marks_go_to_the_model(monkeypatch):
    encode = token_files.PieceEncoder(PATH)
    whole, calls = encode._ids, []
    monkeypatch.setattr(encode, "_ids", lambda text: calls.append(text) or whole(text))
    text = "Begin one two.\nThree four,\nFive über!!\nÉté six$$$ seven"
    assert encode.encode(text) == whole(text)
    assert sorted(calls) == ["\n", "!!", "$$$", ",", ".", "Begin"]  # no word but the first


def test_pieces_equal_the_library_on_odd_white_space(monkeypatch):
    monkeypatch.setattr(token_files, "MAX_PIECES", 5)  # generations change all the time
    monkeypatch.setattr(token_files, "MAX_MARKS", 2)
    encode = token_files.PieceEncoder(PATH)
    parts = [*" \n\t\r\x0b\x1c\x85\xa0'.,!$_1aAéßжσ中٣ª🙂́​　 ﻿", "'s", "n't", " the", "\n\n", "Ünï", "...", "word", "<|endoftext|>"]
    draw = random.Random(3)
    for _ in range(5000):
        text = "".join(draw.choices(parts, k=draw.randrange(14)))
        assert encode.encode(text) == encode._ids(text), text
    assert len(encode) <= 5 and len(encode.older) <= 5 and len(encode.marks) <= 2


def test_other_tokenizers_get_whole_texts():
    encode = token_files.PieceEncoder(public_tokenizers.path("word_bpe_49k.json"))
    for text in ["One  two.\nThree", "á b", "don't STOP\n\n now"]:
        assert encode.encode(text) == encode._ids(text), text
