import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from activitymill.llm import words as w
from tests.llm import corpus


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbBé \t\n. ", max_size=30)), max_size=12), st.integers(1, 40))
def test_words_of_slices_are_those_of_each_text(values, size):
    got = []
    for piece in w.texts(pa.array(values, pa.string()), size):
        found = piece.words()
        for k in range(len(piece)):
            a, b = found.offsets[k], found.offsets[k + 1]
            got.append([bytes(found.data[x:y]).decode() for x, y in zip(found.starts[a:b], found.ends[a:b])])
    assert got == [corpus.words(v) for v in values]


def test_equal_words_have_equal_hashes_wherever_they_are_and_however_long():
    rng = random.Random(1)
    parts = ["x" * 700_000, "ab", "x" * 700_000, "ab", "x" * 699_999 + "y"] + [rng.choice("abc") * rng.randint(1, 9) for _ in range(500)]
    piece = next(w.texts(pa.array([" ".join(parts)])))
    by_word = {}
    for part, value in zip(parts, piece.words().hashes().tolist()):
        assert by_word.setdefault(part, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_shingles_and_distinct():
    values = ["a b c d e f", "a b", "", "b c d e f", "A b", "a a a a a a a a"]
    found, offsets = w.shingles(next(w.texts(pa.array(values))).words())
    sets = [found[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert [len(s) for s in sets] == [2, 1, 0, 1, 1, 4]
    assert sets[0][1] == sets[3][0] and sets[1] == sets[4]
    own, ends, times = w.distinct(found, offsets)
    assert np.diff(ends).tolist() == [2, 1, 0, 1, 1, 1] and times.tolist() == [1, 1, 1, 1, 1, 4]
