"""The piece tokenizer against the library on whole texts."""

import random

import public_tokenizers

from loomis.llm.subword import PieceTokenizer

PARTS = ["a", "b", "Word", "'s", "'ll", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x85", "\xa0", "é", "ß", "日本", "語",
         "한", "7", "½", "!", "...", "<|endoftext|>", "<|", "​", "\U0001f600", "\x1c", "ا", "　", "_", "-",
         "Ω", "̀", "\x00", "\U0001e900"]


def texts(n: int) -> list[str]:
    rng = random.Random(5)
    return [""] + ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_equal_to_library():
    tk = PieceTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert tk.by_piece
    t = texts(5000)
    assert tk.encode(t) == tk.whole(t)


def test_small_cache_and_other_tokenizer():
    """An emptied cache changes nothing; a tokenizer of another kind is used whole."""
    tk = PieceTokenizer(public_tokenizers.path("byte_bpe_50k.json"), limit=40)
    t = texts(300)
    assert [tk.encode([x])[0] for x in t] == tk.whole(t)
    other = PieceTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.by_piece and other.encode(t) == other.whole(t)


def test_new_pieces_are_merged_together():
    """Words met for the first time share calls of the library's model, known
    ones need none; a cleared cache and texts with NUL change nothing."""
    tk = PieceTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    model, calls = tk.model, []

    class Counting:
        def tokenize(self, s):
            calls.append(s)
            return model.tokenize(s)

        def token_to_id(self, s):
            return model.token_to_id(s)
    tk.model = Counting()
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(500)})
    t = [" ".join(words), " ".join(w + "," for w in words), ".\n".join(words)]
    assert tk.encode(t) == tk.whole(t)
    met = len(calls)
    assert met < len(words) // 10
    assert tk.encode(t[::-1]) == tk.whole(t[::-1]) and len(calls) == met
    odd = ["a\0b " + words[0], words[0] + "  x", "", " " + words[1], words[1] + "\n"]
    tk.limit = 10
    assert tk.encode(odd) == tk.whole(odd)
