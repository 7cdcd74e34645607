"""Small fixtures: edge cases and seeded random corpora."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that operators use inside
          "h string, s string, k string, n string, rep string, label string, lo string, hi string, shared string, "
          "gone string, bands string, els string, w string, pos string, item_id string, score string, keep_id string")
EXTRA = len(SCHEMA.split(", ")) - 5


def frame(spark, rows):
    """A documents table of (doc_id, text) rows with extra clashing columns."""
    full = [(i, t, "en", "src0", None if t is None else len(t), *["x"] * EXTRA) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def long_text(n=30_000, seed=5):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abehinorst") for _ in range(rnd.randint(2, 9))) for _ in range(n))


EDGES = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "One two three four"),
    (6, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3),
    (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3),
    (8, "A b C d e f g h i j k l m n o p q r s t u v w x y z " * 3),
    (9, "é ü 你好   x y \U0001f642 ᲊ " * 8), (None, "no id here at all"), (None, None), (-3, "negative id"),
    (10, "same words in one row"), (10, "same words in one row"), (11, "x" * 5000), (12, long_text()),
    (13, "<|endoftext|> special <|startoftext|>"), (14, "\x00nul\x00 and \x1c\x1d controls"),
]


def corpus(seed=0, n=160, vocabulary=400):
    """Random documents with copies, near copies, shared passages and truncations."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(vocabulary)]
    passage = [rnd.choice(words) for _ in range(40)]
    rows = []
    for i in range(n):
        kind = rnd.random()
        if rows and kind < 0.15:
            text = rnd.choice(rows)[1]
        elif rows and kind < 0.5:
            w = rnd.choice(rows)[1].split(" ")
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            if rnd.random() < 0.3:
                w = w[rnd.randint(0, 4):]
            text = " ".join(w)
        else:
            w = [rnd.choice(words) for _ in range(rnd.randint(1, 150))]
            if rnd.random() < 0.3:
                at = rnd.randint(0, len(w))
                w[at:at] = passage
            text = " ".join(w)
        rows.append((i * 7 % 1009, text or "x"))
    return rows
