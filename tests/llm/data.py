"""Small corpora with planted cases for the corpus operators."""

import random

import regex

EDGE_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept string, score string, _id string, "
               "_row string, words string, text_class string, sentences string, `odd name` string")


def prose(seed, n, lines=1):
    rng = random.Random(seed)
    words = [rng.choice("the of and in to is was for that with".split()) if rng.random() < 0.3 else
             "".join(rng.choice("ka lo mi ren tas vu dor shi pel gan".split()) for _ in range(rng.randint(2, 4))) for _ in range(n)]
    step = max(1, n // lines)
    return "\n".join(" ".join(words[i:i + step]) + "." for i in range(0, n, step))


def edge_rows():
    same = prose(1, 120, 4)
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, "word"), (5, same), (6, same), (6, same), (None, same), (None, None),
        (7, prose(2, 40_000, 50)), (8, "a " * 3000), (9, "x" * 5000), (10, prose(3, 60)), (10, prose(4, 60)),
        (11, "É ñ ß İ ſ 😀 é \x1c\x85  <|endoftext|> don't 12,5 " + prose(5, 30)), (12, same + " one more word"),
    ]
    return [(i, t, None if n % 3 else "en", "s", None if t is None else len(t), "k", "s", "i", "r", "w", "c", "q", "o") for n, (i, t) in enumerate(texts)]


def plain_words(text):
    return tuple(w for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", (text or "").lower()) if w)


def shingle_set(text):
    w = plain_words(text)
    return {w[i:i + 5] for i in range(len(w) - 4)} if len(w) >= 5 else ({w} if w else set())


def near_corpus():
    """Documents with exact and near copies of several strengths, and unrelated ones."""
    rng, rows = random.Random(5), []
    for g in range(12):
        base = prose(100 + g, 150).split()
        for k in range(14):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 9])):
                words[rng.randrange(len(words))] = f"new{rng.randrange(9999)}"
            rows.append(" ".join(words))
    rows += [prose(1000 + i, 80) for i in range(40)]
    rng.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]
