import re

import numpy as np

from reviewmill.llm.common import free_name, shingles, word_codes


def word_sets(rows, width):
    """Key -> set of word shingles, by the plain definition."""
    out = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out[key] = {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    return out


def test_words_follow_ascii_blanks():
    codes, counts = word_codes(["A\x0bb\x1cc d É\r\nE", None, " \t", "", "a", "é", "É d"])
    assert counts.tolist() == [5, 0, 0, 0, 1, 1, 2]
    assert codes[0] == codes[5] and codes[3] == codes[7] != codes[6] and codes[2] == codes[8]
    assert word_codes([])[0].tolist() == word_codes([None])[0].tolist() == []


def test_codes_tell_words_apart():
    words = [c * n for c in "abé" for n in range(1, 80)] + ["x" * n + "y" + "x" * (70 - n) for n in range(70)]
    codes, counts = word_codes([" ".join(words), " ".join(words).upper().replace("É", "é"), *words])
    assert len(set(codes.tolist())) == len(words) and counts[0] == counts[1] == len(words)
    assert (codes[:len(words)] == codes[2 * len(words):]).all() and (codes[:len(words)] == codes[len(words):2 * len(words)]).all()


def test_shingles_stay_inside_their_text():
    made = shingles(*word_codes(["a b c d a b c", "b c d", "a b", "a B", "", "b"]), 3)
    assert [len(x) for x in made] == [5, 1, 1, 1, 0, 1]
    assert made[0][0] == made[0][4] and made[0][1] == made[1][0] and made[2][0] == made[3][0]
    assert len(set(np.concatenate(made).tolist())) == 6


def test_free_name():
    assert free_name(["a", "KEY", "key_1"], "key") == "key_2" and free_name([], "key") == "key"
