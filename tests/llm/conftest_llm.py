"""Rows that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

LONG = "word" * 30_000 + " " + "tail of a very long text. " * 3_000
BASE = " ".join(f"w{i * 7919 % 997}" for i in range(220)) + "."
TEXTS = [
    (0, BASE), (1, BASE), (2, BASE.replace("w0 ", "changed ", 1)), (3, None), (4, ""), (5, " \n\t "), (6, LONG), (7, "Short."),
    (8, "a b c\nd e f\n\na b c\n"), (9, "mail me: ann.b@mail.example.com or +1 (487) 555-7209, 4111 1111 1111 1111, 10.0.0.255"), (10, BASE.upper()),
    (None, "a text without an id, long enough to be told from all other texts here"), (None, BASE), (11, "x  y"), (12, "x\ty"), (12, "x\ty"), (13, "é é <|endoftext|> ΑΣ 漢字 🙂"),
]
ODD_TEXTS = [t or "" for _, t in TEXTS] + [
    "ΑΣ Σ a", "İi Ⅷ ²³ ½", "a<|endoftext|>b <|startoftext|>", "\x1c x\x85y\xa0z\xad", "é é ñ", "'S'T 'rex !'s '", "a　b", " \n\n  x", "漢字 kana かな 🙂👍", "\0 nul\0l"]
_EXTRA = "class_id long, key string, kept string, score double, ids binary, maybe string"


def frame(spark, rows=TEXTS):
    """A documents table with null columns and extra ones whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, None, None, *[None] * 6) for i, t in rows], f"doc_id long, text string, lang string, source string, n_chars long, {_EXTRA}")


def plain(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def rows_of(df, *columns):
    """Rows as sorted tuples, nulls last."""
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=lambda t: [(x is None, str(type(x)), x if x is not None else 0) for x in t])
