"""Rows that every operator has to get through."""

LONG = "lorem ipsum dolor sit amet " * 8000

#: Nulls, empty and white texts, a very long one, equal ones, a repeated row, null ids, unusual characters.
EDGE_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog, released under the MIT license."),
    (2, "THE QUICK brown fox jumps over the lazy dog, released under the MIT license."),
    (3, None),
    (4, ""),
    (5, " \n\t  "),
    (6, LONG),
    (7, "word"),
    (None, "a text without an id, and some more words in it"),
    (None, None),
    (8, "ÀÉ straße 日本 <|endoftext|> it's  two  blanks\n\n ½ don't' \x85 \x00"),
    (8, "ÀÉ straße 日本 <|endoftext|> it's  two  blanks\n\n ½ don't' \x85 \x00"),
    (9, "123 456!"),
    (10, None),
]
