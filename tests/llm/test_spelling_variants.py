import random
import re
from collections import Counter
from zlib import crc32

import pytest

from tripyard.llm import spelling_variants

from .texts import SCHEMA, corpus, frame, lower

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    """Whether one insertion, deletion or replacement makes a of b."""
    if len(a) < len(b):
        a, b = b, a
    if a == b or len(a) - len(b) > 1:
        return False
    at = next((i for i in range(len(b)) if a[i] != b[i]), len(b))
    return a[at + 1:] == (b[at + 1:] if len(a) == len(b) else b[at:])


def brute(rows, least=7, times=2, ratio=10):
    counted = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            word = lower(run)
            if doc is not None and (h := crc32(f"{doc}:{word}".encode())) % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counted[word] += 1
    n = {w: c for w, c in counted.items() if len(w) >= least and c >= times}
    out = {}
    for word in n:
        near = [o for o in n if one_edit(word, o)]
        best = min(near, key=lambda o: (-n[o], o), default=None)
        form = best if best and n[best] >= ratio * n[word] else None
        out[word] = (n[word], len(near), form, n[form] if form else None)
    roots = {}
    for word in n:
        end = word
        while out[end][2]:
            end = out[end][2]
        roots[word] = end
    return {(w, *v, roots[w]) for w, v in out.items()}


def family(seed):
    """Documents with chains of variants, words of one stem, and odd texts."""
    rng = random.Random(seed)
    stem = "überaus"
    words = [(stem + "".join(rng.choice("abcé") for _ in range(rng.randint(0, 5))), rng.randint(1, 3)) for _ in range(150)]
    words += [("Internationale", 400), ("internationalle", 30), ("intrnationalle", 3), ("xinternationale", 40), ("internationalex", 40)]
    words += [("".join(rng.choice("ab") for _ in range(rng.randint(7, 9))), rng.choice([1, 2, 25])) for _ in range(150)]
    words += [("w" * 3000, 2), ("w" * 3001, 2), ("w" * 1500 + "v" + "w" * 1500, 2), ("zzzzzzz", 4), ("zzzzzzzz", 60), ("zzzzzzzzz", 900)]
    every = [w for w, n in words for _ in range(n)]
    rng.shuffle(every)
    rows = [(i, " ".join(every[i::40])) for i in range(40)]
    return rows + [(None, "Internationale internationa" * 2), (None, None), (7, ""), (7, rows[7][1]), (-3, "straße×÷ ÀÉÎõü Straßen÷7straßenx"), (2**40, "ABCDEFG-abcdefg")]


@pytest.mark.parametrize("group", [512, 8])
def test_words_forms_and_roots_are_those_of_brute_force(spark, group):
    rows = family(3)
    got = spelling_variants.group_variants(frame(spark, rows), group=group).select("word", "n", "n_near", "form", "form_n", "root")
    want = brute(rows)
    assert {tuple(r) for r in got.collect()} == want
    assert len([r for r in want if r[3]]) > 20 and any(r[5] != r[3] and r[3] for r in want)


def test_texts_of_the_shared_corpus(spark):
    rows = corpus(8)
    got = spelling_variants.group_variants(frame(spark, rows)).select("word", "n", "n_near", "form", "form_n", "root")
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_each_pair_comes_out_once_in_both_directions(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(7, 10))) for _ in range(400)})
    table = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long").repartition(5)
    got = [tuple(r) for r in spelling_variants.near_words(table, group=16).collect()]
    assert len(got) == len(set(got))
    assert {r[:2] for r in got} == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_tables_without_rows_or_words(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert spelling_variants.group_variants(empty).collect() == []
    assert spelling_variants.group_variants(frame(spark, [(1, None), (2, "one two"), (None, "12345678")])).collect() == []
