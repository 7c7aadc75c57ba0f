"""Small tables with every awkward case, and helpers."""

import os

SF = "/root/testdata/sf0.001"
LONG = "word " * 30_000
TEXTS = [
    None, "", " \n\t ", "one", "Two words", "a b c", "A b C", "a b c d e f g " * 20, "a b c d e f g " * 20, LONG, "x" * 50_000, "1" * 20_000,
    "é è ê ñ ß ö 日本語 \U0001d4b3 text", "mail me at ann.b@example.com or +1 (212) 555-0199, card 4111 1111 1111 1111, host 10.0.0.255",
    "l1\nl1\nl1\n\n\nl2", "### $$$ %%% &&& *** | | <b>", "don't 'S we'll they're I'd 'tis <|endoftext|> x", "\x00\x1f\x85 ",
]


def docs(spark, texts=None, extra=True):
    """doc_id, text, lang, source and columns whose names clash with the operators' own."""
    texts = TEXTS if texts is None else texts
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "a", "b"][i % 3], len(t or ""), 7, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n long, value string")
    df = df.withColumnsRenamed({"n": "size", "value": "id"})
    return df if extra else df.drop("size", "id")


def nothing(spark):
    return docs(spark).limit(0)


def there(name=SF):
    return os.path.isdir(name)
