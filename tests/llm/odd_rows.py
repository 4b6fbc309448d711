"""Rows every operator must take: null, empty, blank, without id, repeated, one id with two texts."""

ODD = [(1, None), (2, ""), (3, "   "), (None, "one text without an id"), (4, "twice"), (4, "twice"), (4, "thrice, same id")]
