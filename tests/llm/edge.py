"""Tables with every awkward case: null ids and texts, empty and blank texts, repeats, ties, clashing extra columns, a long text."""

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away home"), (2, None), (3, ""), (4, " \t\n"), (5, "short"), (6, "short"),
    (7, "The quick  brown fox jumps over the lazy dog and runs away home "), (None, "a text without an id, long enough to hold a line"), (None, None),
    (8, "line one is here\nline two is here\n\nline one is here"), (9, "LINE ONE IS HERE  \nsomething else"), (9, "LINE ONE IS HERE  \nsomething else"),
    (10, "word " * 5000), (11, "émile zola écrit à l'été " * 40), (12, "émile zola écrit à l'été " * 40), (-3, "negative id " * 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, digest string, keys string, lines_before string, share int, __id long, __lost string, `my col` string, `a-b` int, doc string, none string, rest string, `row.x` string"


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "en", None, None, "x", 7, None, "k", "b", 1, 9, "l", "m", 2, "d", "n", "r", "q") for i, t in rows], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
