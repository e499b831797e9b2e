import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripyard.llm import packing

from .texts import corpus, frame

TOKENIZER = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def ids_of(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def odd_texts():
    rng = random.Random(3)
    out = ["", " ", "It's 's a b c\x1cd\x85e <|endoftext|>x <|startoftext|>", "AB<|endoftext|>. <|ENDOFTEXT|>! <|endoftext|>,",
           "Á ́e ΑΣ ΟΔΟΣ. İ ǅ ﬁ 12３4 ½ 가 ᄀ ᅡ Å Å.", "​﻿ x\x00y 't 're", "don't  WE'LL\n\n\tx\x0b\x0cy l'eau. x'S. é's"]
    out += [f"ab{chr(c)}cd. {chr(c)} x{chr(c)}! {chr(c).upper()}ing," for c in range(0x80, 0x260)]
    letters = ",!%.aZ'stre0 \ńéé  <|>endoftext½ßΣ\U0001F600ͅᅡᄀ"
    return out + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(4000)]


def test_words_give_the_ids_of_whole_texts():
    coder = packing._coder(packing.VOCABULARY)
    for text in [*odd_texts(), *(t for _, t in corpus() if t)]:
        assert coder.text(text.encode()) == ids_of(text)[:-1].tobytes(), text[:80]


def test_eviction_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 4000)
    coder = packing.WordIds(public_tokenizers.path(packing.VOCABULARY))
    for _, text in corpus(2, 20):
        assert coder.text((text or "").encode()) == ids_of(text)[:-1].tobytes()
    assert len(coder) < 40_000


@pytest.mark.parametrize("capacity", [2048, 7])
def test_best_fit_is_the_tightest_open_sequence(capacity):
    lengths = np.random.default_rng(capacity).integers(1, capacity + 1, 700)
    sequence, offset = packing.best_fit(lengths, capacity)
    left, places = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        fits = [(room, k) for k, room in enumerate(left) if room >= lengths[i]]
        if not fits:
            left.append(capacity)
        k = min(fits)[1] if fits else len(left) - 1
        left[k] -= lengths[i]
        places[i] = left[k]
    assert sequence.max() + 1 == len(left)
    assert [int(capacity - offset[i] - lengths[i]) for i in range(len(lengths))] == [int(places[i]) for i in range(len(lengths))]


def check_packing(rows, capacity=packing.CAPACITY):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_and_places(spark):
    rows = corpus()
    got = packing.packed_documents(frame(spark, rows)).collect()
    want = []
    for i, t in rows:
        ids = ids_of(t)
        for k, lo in enumerate(range(0, len(ids), packing.CAPACITY)):
            part = ids[lo:lo + packing.CAPACITY]
            want.append((i, k, lo, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    used = check_packing(got)
    assert used <= 1.02 * sum(w[3] for w in want) / packing.CAPACITY + 2


def test_shards_lose_little(spark):
    rng = random.Random(1)
    data = [(i, i, 0, 0, rng.randint(1, 2048), 0) for i in range(4000)]
    pieces = spark.createDataFrame(data, packing.PIECES)
    got = packing.pack(pieces, shard_pieces=500).collect()
    assert len(got) == 4000 and len({r["sequence_id"] // 2 >> 32 for r in got if not r["sequence_id"] % 2}) == 8
    assert check_packing(got) <= 1.05 * sum(d[4] for d in data) / 2048


def test_ids_are_kept_on_request(spark):
    rows = packing.tokenised(frame(spark, corpus(4, 5)), keep_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)


def test_empty_table(spark):
    assert packing.packed_documents(frame(spark, [])).collect() == []
