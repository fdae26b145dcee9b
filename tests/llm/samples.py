"""Small documents for the tests: words that repeat, and odd cases."""

import random

VOCABULARY = [a + b for a in ("ba", "ke", "lo", "mi", "nu", "ra", "so", "té", "vi", "zo") for b in ("", "ld", "rn", "st", "x", "ß")]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) + r.choice(["", "", "", ".", ","]) for _ in range(n))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, n long, cid string, _row long, key double, start string, spans int"


def rows():
    texts = [prose(i, 20 + 7 * i % 150) for i in range(40)]
    texts += [texts[3], texts[3] + " tail", texts[5].upper(), texts[7][:200] + prose(99, 40), prose(98, 15) + texts[7][50:250], "", None, " \n\t ", "one", "One two three", "one  two three", "x" * 500, "ab" * 400]
    texts += [prose(1, 3000), prose(1, 3000)[:9000] + " end", "password = 'hunter2222' and AKIA" + "Q" * 16, "under the MIT License; cc-by-nc 4.0", "<s>▁ <|endoftext|> 日本 😀\x00"]
    out = [(i, t, "en", "src", len(t or ""), 7, 1, "c", 5, 0.5, "s", 2) for i, t in enumerate(texts)]
    out.append(out[3])  # a row again
    out.append((9, texts[9] + " other text of the same id", "en", None, None, None, None, None, None, None, None, None))
    return out
