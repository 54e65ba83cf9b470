"""A small table of every odd kind of row."""

COMMON = (
    "The quick brown fox jumps over the lazy dog while the sun sets slowly behind the old stone mill by the river, "
    "and the miller counts his sacks before the long night begins."
)
#: Texts of every odd kind; ids with a null, a tie of texts and a row that repeats whole.
ROWS = [
    (1, COMMON, "a"),
    (2, COMMON, "a"),
    (2, COMMON, "a"),
    (3, None, "b"),
    (4, "", None),
    (5, "   \n\t ", "b"),
    (6, "Mail bob.smith+x@mail.example.com or bad@x, a@b@c.de_f@g.hi; 10.0.0.255 and 1.2.3.256.7.8.9", "c"),
    (7, "card 4111 1111 1111 1111 call +1 (415) 555-2671 or +1 2 and 4111111111111112", "a"),
    (8, "token=token: abcdefgh API_KEY = 'x1/y2==zz' passwd:abc AKIA" + "A1" * 10 + " " + "0f" * 20, "ä"),
    (9, "x" * 120_000 + " " + "aaaa " * 5_000, "a"),
    (10, "Intro words differ here. " + COMMON + " And so does the end.", "b"),
    (11, "Été İstanbul straße <|endoftext|> \U0001f600 it's 2nd\x1crun", "c"),
    (12, COMMON.upper(), "c"),
    (None, COMMON, "a"),
    (13, "one two", "b"),
]
#: Items of a search: a null and an empty one, a tie, an item that repeats whole, two that share an id, one without an id.
ITEMS = [
    (1, "The quick brown fox"),
    (2, None),
    (3, "..."),
    (4, "Words DIFFER words words 2nd"),
    (4, "Words DIFFER words words 2nd"),
    (5, "Été straße \U0001f600"),
    (5, "aaaa"),
    (6, "unheard-of"),
    (None, "the river"),
]
