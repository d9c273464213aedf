"""Texts longer than a part give what they give whole, and don't take memory by their length."""

import subprocess
import sys

import numpy as np
import pytest

from tidemark.llm import language_id, quality

WORDS = ["der", "Hund", "STRASSE", "ΣΟΦΙΑΣ", "мир", "naïve", "x9", "--", "a.b", "日本語", " "]


def text(seed, n, gaps=(" ", "\n", "  ", "")):
    rng = np.random.default_rng(seed)
    return "".join(WORDS[w] + gaps[g] for w, g in zip(rng.integers(0, len(WORDS), n), rng.integers(0, len(gaps), n), strict=True)).encode()


@pytest.fixture()
def short_parts(monkeypatch):
    monkeypatch.setattr(language_id, "PART", 64)
    monkeypatch.setattr(quality, "PART", 64)


@pytest.mark.parametrize("seed", range(8))
def test_parts_add_up_to_the_whole(short_parts, seed):
    for body in (text(seed, 400), b"7 " * 300 + b"ab", b" " * 500, b"-" * 1000 + b"w", "日本".encode() * 200):
        assert b"".join(language_id.parts(body)) == body
        whole = language_id.gram_codes([language_id.letters(body)])[0]
        split = [c for p in language_id.codes_by_part(body) for c in p.tolist()]
        assert split == whole.tolist()
        for got, want in zip(language_id.counted_codes(body), np.unique(whole, return_counts=True), strict=True):
            assert got.tolist() == want.tolist()


def test_quality_features_by_parts(monkeypatch):
    bodies = [text(n, 300) for n in range(4)] + [None, b"", b"a"]
    whole = quality.features(bodies)
    monkeypatch.setattr(quality, "PART", 64)
    assert np.allclose(quality.features(bodies), whole, atol=1e-6)


@pytest.mark.parametrize("call", ["language", "quality"])
def test_sixty_million_bytes_take_little_memory(call):
    """In a process of its own: what the work adds to the text itself."""
    body = """
import resource, sys
import numpy as np
from tidemark.llm import language_id, quality
text = b"eins zwei drei vier " * 3_000_000
model = language_id.LanguageFilter(["de", "en"], np.ones((1 << 10, 1), np.uint64), 3, "de")
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
names = model.predict([text])[0] if sys.argv[1] == "language" else quality.features([text])
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", body, call], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 300
