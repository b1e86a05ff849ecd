"""Texts that several tests use, and how results are compared."""

LICENSE = "Released under the MIT License.\nAll rights reserved."
PROSE = "the cat sat on the mat and looked at the moon over the quiet hills of the old town"
PASSAGE = "\n".join(f"line {k} of a passage with several plain words that every copy has at this place {k}" for k in range(5))
ODD = "ﬁne ＡＢＣ naïve İstanbul 日本語 🙂 a\tb\r\nc  d\x0be\x00f"


def same(found, expected):
    """Equal as multisets; null ids compare by their text form."""
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, map(tuple, expected)))
