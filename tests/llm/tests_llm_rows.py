"""Small tables of odd documents."""

SMALL = "/root/testdata/sf0.001"

LONG = " ".join(f"word{n % 977} is{n % 13}." for n in range(40_000))
PLAIN = " ".join(f"the house{n} of stone{n * 7 % 101} and water{n * 3 % 97} is old" for n in range(30))

# Nulls in any column, empty and very long texts, ties and repeated rows; columns named like those that operators add.
ODD_ROWS = [
    (1, PLAIN, "en", "a", 5, 0.5, 7, "x"), (1, PLAIN, "en", "a", 5, 0.5, 7, "x"), (2, PLAIN, "en", "b", 5, 0.1, 8, "y"),
    (3, None, None, None, None, None, None, None), (4, "", "en", "a", 0, 0.2, 9, "z"), (5, " \n\t ", "de", "c", 4, 0.2, 9, "z"),
    (6, LONG, "en", "a", len(LONG), 0.3, 1, "u"), (None, PLAIN + " end", "en", "a", 9, 0.9, 1, "v"),
    (7, "one", "en", "a", 3, 0.9, 2, "w"), (8, "ünïcode 漢字 🙂 <|endoftext|> it's  two spaces", "fr", "d", 9, None, 3, "t"),
    (9, "a" * 5000, "en", "a", 5000, 0.4, 4, "s"), (9, "same id, other text", "en", "a", 19, 0.4, 4, "s"),
]
ODD_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, shard int, ids string"
