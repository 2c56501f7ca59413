import re

import numpy as np
import pyarrow as pa
import pytest

from daymosaic.llm import texts

SAMPLES = ["", None, "a", " a  B\tc\n", "Ünï cödé x", "x" * 5000 + " y", "\x00 nul\x1fx", "日本 語", "tail "]


def words(text, pattern):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(pattern, lower)


@pytest.mark.parametrize("stretch", [7, 64, 1 << 20])
@pytest.mark.parametrize("to, pattern", [
    (texts.BLANK_WORDS, r"[^\x20\x09-\x0D]+"), (texts.PLAIN_WORDS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_and_their_hashes(monkeypatch, stretch, to, pattern):
    monkeypatch.setattr(texts, "STRETCH", stretch)
    hashes, offsets = texts.word_hashes(pa.array(SAMPLES, pa.string()), to)
    expected = [words(s, pattern) for s in SAMPLES]
    assert np.diff(offsets).tolist() == [len(w) for w in expected]
    flat = [w for ws in expected for w in ws]
    # equal words, and only those, have equal hashes
    assert len(dict(zip(flat, hashes.tolist()))) == len(set(hashes.tolist())) == len(set(zip(flat, hashes.tolist())))


def test_slices_keep_their_offsets():
    column = pa.array(SAMPLES, pa.string())
    whole, offsets = texts.word_hashes(column)
    part, own = texts.word_hashes(column.slice(3, 4))
    assert part.tolist() == whole[offsets[3]: offsets[7]].tolist() and len(own) == 5


def test_windows_stay_in_their_text():
    text, place = texts.window_starts(np.array([0, 3, 3, 8]), 3)
    assert text.tolist() == [0, 2, 2, 2] and place.tolist() == [0, 3, 4, 5]
