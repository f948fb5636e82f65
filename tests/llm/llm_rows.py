"""Rows that no operator may stumble over."""

ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t  "),
    (4, "word"),
    (None, "a row without an id that has some words in it"),
    (5, "ties and ties and ties and ties and ties and ties"),
    (6, "ties and ties and ties and ties and ties and ties"),
    (6, "ties and ties and ties and ties and ties and ties"),
    (7, "!!! ??? 123 éè 日本語 \U0001f642 <|endoftext|>"),
    (8, "a very long text " * 40000),
    (9, None),
]
