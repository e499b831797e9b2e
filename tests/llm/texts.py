"""Fixtures and plain-Python counterparts shared by the operator tests."""

import random
import re

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Columns of ``documents`` and extra ones whose names clash with internal names.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, n long, token string, "
          "prefix string, h string, group_size long, component_id long, lang_pred string, score double, term string, piece int")
EXTRA = (7, 8, "x", "y", "z", 9, 10, "p", 0.5, "t", 3)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def vocabulary(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(rng.randint(1, 9))) for _ in range(n)]


def prose(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def corpus(seed=1, n=60):
    """(doc_id, text) rows: copies, near copies, shared lines, odd texts, ties."""
    rng, words = random.Random(seed), vocabulary(seed)
    lines = [prose(rng, words, 12) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [prose(rng, words, rng.randint(1, 60)) for _ in range(rng.randint(1, 4))]
        parts += [rng.choice(lines) for _ in range(rng.randint(0, 3))]
        rng.shuffle(parts)
        rows.append((i, "\n".join(parts)))
    base = prose(rng, words, 120)
    for i in range(n, n + 25):  # near copies of one text, a few words changed
        own = base.split()
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((i, " ".join(own)))
    rows += [(n + 25 + i, base if i % 2 else base.upper().replace(" ", "  ")) for i in range(8)]
    odd = [None, "", " \n\t ", "one", "One two", "!!! ... ---", "été ÉTÉ ß 中文 文本", "x\x00y z\x85w", "a\r\nb\rc", "\n\n",
           "long " * 30_000, "w" * 20_000, "  " + lines[0] + "\t", lines[0].upper() + "\n" + lines[1]]
    rows += [(n + 40 + i, t) for i, t in enumerate(odd)]
    rows += [(3, rows[3][1]), (None, base), (None, None), (-5, base), (2**40, lines[2])]
    return rows


def frame(spark, rows, partitions=3):
    """Rows as a table with all the columns of ``documents`` and clashing ones."""
    data = [(i, t, None, None, len(t or ""), *EXTRA) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(partitions)


def found(df):
    return [tuple(r) for r in df.collect()]


def mirrored(size):
    """Two words of ``size`` letters (a power of two): the Thue-Morse word over
    a and b, and the one with its letters exchanged. Polynomial hashes modulo
    2^64 give both the same value from 1,024 letters on."""
    bits = [bin(i).count("1") & 1 for i in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


LONG_PAIRS = [mirrored(size) for size in (1024, 2048, 4096)]
