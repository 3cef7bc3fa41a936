"""Packing: the plan against best-fit one piece at a time, the places against the pieces."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from songloom.llm.packing import best_fit, cut, packed_documents
from songloom.llm.tokenizing import tokenizer_path


def one_by_one(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


def test_plan_equals_best_fit_one_piece_at_a_time():
    r = random.Random(6)
    for _ in range(200):
        capacity = r.choice([7, 20, 64])
        lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 120))]
        plan = best_fit(Counter(lengths), capacity)
        assert Counter(x for content, n in plan for x in content * n) == Counter(lengths)
        assert sorted(capacity - sum(content) for content, n in plan for _ in range(n)) == one_by_one(lengths, capacity)


def test_cuts():
    assert list(cut(5, 8)) == [(0, 5)] and list(cut(8, 8)) == [(0, 8)]
    assert list(cut(19, 8)) == [(0, 3), (3, 11), (11, 19)]


def test_pieces_and_places(spark):
    r = random.Random(7)
    words = ["the", "tion", "Über", "\n", "<|endoftext|>", "12"]
    rows = [(i, " ".join(r.choices(words, k=r.choice([0, 1, 5, 40, 400, 3000])))) for i in range(150)]
    rows += [(900, None), (None, "x"), (3, rows[3][1])] + [(1000 + i, "same text") for i in range(2500)]
    frame = spark.createDataFrame([(i, t, 5, 6) for i, t in rows], "doc_id long, text string, length int, offset int")
    got = packed_documents(frame).collect()

    library = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for i, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for k, (a, b) in enumerate(cut(len(ids), 1024)):
            want[(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((g.doc_id, g.piece, g.start, g.length, g.ids_crc32) for g in got) == want
    sequences = defaultdict(list)
    for g in got:
        sequences[g.sequence_id].append((g.offset, g.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) == len(one_by_one([g.length for g in got], 1024))


def test_empty_table(spark):
    assert packed_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
