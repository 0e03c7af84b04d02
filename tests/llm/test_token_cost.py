"""What a new word and a plane of bits cost, apart from their results."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from quarterdeck.llm import token_store
from quarterdeck.llm.queries import TOKENIZER
from quarterdeck.llm.wavelet import WaveletMatrix


def test_new_words_are_not_taken_for_lines(monkeypatch):
    """Words, with marks after them or not, go to the model at once; the rest as before."""
    encode, lines = token_store.Encoder(public_tokenizers.path(TOKENIZER)), []
    plain = encode._lines
    monkeypatch.setattr(encode, "_lines", lambda piece: lines.append(piece) or plain(piece))
    texts = ["Uvul, grenz brxt.,. Ünder qqq", "q.\nuvulb zed\nend.", ". .. ,a a1 b_c uvul's  two ", "", "x .", "été́ naïve，你好 ok"]
    ids, bounds = encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids
    assert lines and not [piece for piece in lines if piece.rstrip(".,").removeprefix(" ").isalpha()]


def test_no_plane_is_cut_by_a_mask(monkeypatch):
    """Positions in place of masks, in both directions."""
    seen, found = [], np.flatnonzero
    monkeypatch.setattr(np, "flatnonzero", lambda x: seen.append(1) or found(x))
    values = np.random.default_rng(1).integers(0, 1 << 5, 1000).astype(np.uint16)
    matrix = WaveletMatrix.of(values, 5)
    assert len(seen) == 10
    assert (WaveletMatrix.from_bytes(matrix.to_bytes()).decode() == values).all() and len(seen) == 20
