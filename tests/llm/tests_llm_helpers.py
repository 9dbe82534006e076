import re


def words_of(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


#: Nulls, empty and blank texts, repeats and ties, a long text, and a column with a clashing name.
ODD = "doc_id long, text string, rep long, bands string, chunk string, size string, lines_removed string"


def odd_rows():
    texts = [
        (1, "one two three four five six seven eight"),
        (2, "one two three four five six seven eight"),
        (2, "one two three four five six seven eight"),
        (None, "one two three four five six seven eight"),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, "word " * 30_000),
        (None, "alone in the world without an id of its own"),
        (None, None),
        (7, "a b"),
        (7, "quite another text that has the same id as the row above it"),
    ]
    return [(i, t, 1, "x", "y", "z", "w") for i, t in texts]
