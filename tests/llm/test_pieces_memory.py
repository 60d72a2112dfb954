"""What a worker holds while it cuts words."""

from __future__ import annotations

import tracemalloc

import numpy as np

from linksift.llm import pieces
from linksift.llm.common import tokenizer_file


def test_draws_take_a_bounded_part_at_a_time():
    """All candidates of a portion were drawn at once: 130 MB for these 300,000 occurrences."""
    m = pieces.Pieces(tokenizer_file("piece_bpe_32k.model"), 17, 0.1)
    words = ["information", "considerable", "government", "understanding", "international"]
    course = np.tile(m.add_words(words), 60_000)
    key = pieces._mix(np.arange(len(course), dtype=np.uint64))
    m.follow(course[:50_000], key[:50_000])
    tracemalloc.start()
    m.follow(course, key)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000


def test_courses_hold_no_objects_of_their_own():
    """A course after struck merges was a tuple of Python objects beside its numbers."""
    m = pieces.Pieces(tokenizer_file("piece_bpe_32k.model"), 17, 0.4)
    m.encode(["understanding " * 3_000], [1])
    assert m.courses.word.n > 100 and len(m.courses.words) <= 2


def test_words_met_once_leave_no_course():
    """Each word met for the first time left a course, and one more for each first struck merge."""
    m = pieces.Pieces(tokenizer_file("piece_bpe_32k.model"), 17, 0.1)
    words = [f"considerable{i}" for i in range(500)]
    once = m.encode([" ".join(words)], [1])
    assert m.courses.word.n < 10  # two words may share a place for words met once
    again = m.encode([" ".join(words)], [1])
    assert m.courses.word.n >= 490 and once[0].tolist() == again[0].tolist()


def test_texts_are_read_a_portion_at_a_time():
    """A batch was turned into Python texts whole."""
    assert list(pieces._portions([600_000, 300_000, 200_000, 5_000_000, 1, 0])) == [(0, 2), (2, 3), (3, 4), (4, 6)]
