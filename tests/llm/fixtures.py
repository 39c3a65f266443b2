"""Hand-made documents with every awkward case, and loaders."""

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, node string, size string, "
          "row string, class_id string, shard string, kind string")
LONG = "alpha beta gamma delta " * 20_000
ROWS = [
    (1, None, None, None, None), (2, "", "en", None, 0), (3, " \t\n", "en", "s", 3), (4, LONG, "en", "s", len(LONG)),
    (5, "one two three four five six seven eight nine ten eleven", "en", "s", 1),
    (5, "one two three four five six seven eight nine ten eleven", "en", "s", 1),
    (6, "one two three four five six seven eight nine ten eleven", "en", None, 1),
    (7, "mail a.b@c.example.com or +1 (456) 555-2186, 4111 1111 1111 1111 at 10.2.3.4\u0001\U0001F600 x@y.de", "en", "s", 1),
    (8, "ñandú été über straße", "es", "s", 1), (9, "x" * 30_000, "en", "s", 1), (10, "12345 678", None, "s", 1),
    (None, "no id here", "en", "s", 1), (11, "One TWO three", "en", "s", 1),
]


def documents(spark, rows=ROWS):
    """Columns of documents, and others whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1.5, "n", "z", "r", "c", "h", "k") for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")
