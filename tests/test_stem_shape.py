from hypothesis import given
from hypothesis import strategies as st

from foretell.functions.stemming import _shape, stem_word


@given(st.text(alphabet="abcdevyiouxyzy", max_size=12))
def test_shape_letter_by_letter(word):
    want = []
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and want and want[-1] == "c")
        want.append("v" if vowel else "c")
    assert _shape(word) == "".join(want)


@given(st.text(max_size=12))
def test_any_text_has_a_stem(word):
    assert len(stem_word(word)) <= len(word.lower()) + 1
