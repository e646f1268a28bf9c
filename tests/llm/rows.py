"""Documents that every operator has to handle: nulls, ties, repeats, empty and very long texts,
and columns whose names clash with those of the results."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, values int, bucket string, deal int"


def documents(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), "x", 1, "b", 2) if not isinstance(t, tuple) else (t[0], t[1], None, None, None, None, None, None, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


HARD = [
    None,
    "",
    " ",
    "a",
    "One line of text. And another one.\nA second line, café \U0001f600 naïve.",
    "One line of text. And another one.\nA second line, café \U0001f600 naïve.",
    "word " * 30_000,
    "x" * 50_000,
    (None, "no id"),
    (None, None),
    (7, "x" * 50_000),
    "\x1c\x85　 <|endoftext|> ́e ΑΣ ΑΣΑ İstanbul 'll we're 123",
]
