"""Rows shared by the tests of this folder."""

#: Rows that every operator on documents has to take: nulls, empty texts, repeated rows.
ODD_ROWS = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \n\t ", "en", None),
    (4, "one", None, "a"),
    (5, "same text here", "en", "b"),
    (5, "same text here", "en", "b"),
    (6, "Same TEXT here", "en", "b"),
    (None, "no id", "en", "a"),
    (7, "é" * 3000, "fr", "c"),
    (8, "12345 !!! 678", "en", "c"),
]
