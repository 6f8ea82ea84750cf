import os
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm.encoding import TOKENIZER_DIR, decode_tree, encode_tree, load_tokenizer
from ledgerloom.llm.packing import SumOfSquares
from ledgerloom.llm.personal import find, redact

TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \n\t'a1.é好\xa0　"), st.characters(exclude_categories=("Cs",))), max_size=60)


@pytest.mark.skipif(not os.path.exists(f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken"), reason="no tokenizer files")
@settings(deadline=None, max_examples=300)
@given(TEXT, st.integers(1, 9))
def test_trees_encode_and_decode_exactly(text, leaf):
    tok = load_tokenizer()
    ids = list(encode_tree(tok, text, leaf))
    assert ids == tok.encoding.encode_ordinary(text) and decode_tree(tok, ids, leaf) == text


@given(st.integers(1, 30).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=80))))
def test_bins_never_overflow_and_counts_stay_true(case):
    capacity, sizes = case
    p, fill = SumOfSquares(capacity), defaultdict(int)
    for s in sizes:
        fill[p.place(s)] += s
    assert all(n <= capacity for n in fill.values()) and len(fill) == p.bins
    gaps = defaultdict(int)
    for n in fill.values():
        gaps[capacity - n] += 1
    assert all(p.counts[g] == gaps[g] for g in range(1, capacity))


@settings(deadline=None)
@given(st.lists(st.one_of(TEXT, st.sampled_from(["Dr. Zanvane", "x@y.example", "(310) 555-0185", "SSN 931-40-2740", "12 Oak St", "PO Box 12", " at ", "İ"])), max_size=8).map("".join))
def test_occurrences_are_ordered_and_apart_and_the_rest_stays(text):
    spans = find(text)
    assert all(0 <= a < b <= len(text) for _, a, b in spans)
    assert all(x[2] <= y[1] for x, y in zip(spans, spans[1:]))
    rest, at = [], 0
    for kind, a, b in spans:
        rest += [text[at:a], f"[{kind}]"]
        at = b
    assert redact(text) == "".join(rest) + text[at:]
