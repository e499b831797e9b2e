import hashlib
from collections import Counter, defaultdict

import pytest

from tripyard.llm import exact_dedup

from .texts import corpus, frame

SPACE = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(SPACE)].append((i, len(t or "")))
    out = Counter()
    for text, own in groups.items():
        best = min(own, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        kept = 0
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i, n in own:
            keep = not kept and (i, n) == best
            kept += keep
            out[(i, best[0], len(own), keep, sha)] += 1
    return out


@pytest.mark.parametrize("heavy", [1, 256])
def test_groups_are_those_of_brute_force(spark, heavy):
    rows = corpus()
    assert Counter(tuple(r) for r in exact_dedup.exact_groups(frame(spark, rows), heavy=heavy, tracked=64).collect()) == brute(rows)


def test_one_hot_group(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(3000)]
    got = exact_dedup.exact_groups(frame(spark, rows, 7)).where("kept").count()
    assert got == 1001


@pytest.mark.parametrize("fan_in", [1, 2, 64])
def test_sketches_merged_in_a_tree_find_what_one_sketch_must(spark, fan_in):
    """A digest with more than rows / tracked members is among the candidates."""
    rows = [(i, f"hot {i % 5}" if i % 2 else f"text {i}") for i in range(4000)]
    found = exact_dedup.frequent_digests(exact_dedup.digests(frame(spark, rows, 11)), heavy=16, tracked=64, fan_in=fan_in)
    got = {r.text_sha256 for r in found.collect()}
    assert {hashlib.sha256(f"hot{k}".encode()).hexdigest() for k in range(5)} <= got and len(got) <= 16


def test_empty_table(spark):
    assert exact_dedup.exact_groups(frame(spark, [])).collect() == []


def test_dropping_keeps_columns_and_one_row_a_group(spark):
    rows = corpus()
    docs = frame(spark, rows)
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    texts = [(r["text"] or "").translate(SPACE) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({(t or "").translate(SPACE) for _, t in rows})


def test_the_longest_row_stays_where_ids_are_null_or_repeat(spark):
    rows = [(None, "a b"), (None, " a  b "), (None, "a  b"), (7, "xy"), (7, "x   y"), (7, "x y"),
            (3, "p q"), (3, "p  q"), (2, "p  q"), (None, "p  q"), (7, "other"), (None, None), (None, "  ")]
    for parts in (1, 3):
        left = exact_dedup.drop_exact_copies(frame(spark, rows, parts))
        assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(
            [(None, " a  b "), (7, "x   y"), (2, "p  q"), (7, "other"), (None, "  ")])
